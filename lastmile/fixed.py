"""Fixed values the results depend on.

These are business constants of the delivery pipeline: parse formats, the
accepted weight range, the SLA bound, the ranking threshold and the canonical
value maps. Every operator takes them as keyword defaults so a caller can
override them; the defaults below are what the KPI tables are defined with.
"""

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------
# Timestamp formats tried in order: ISO first, then day/month/year.
TIMESTAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss")
# Hire date format of the courier feed.
HIRE_DATE_FORMAT = "yyyy-MM-dd"
# Postal codes are left-padded with this character to this width.
ZIP_WIDTH = 5
ZIP_PAD = "0"
# Accepted parcel weight in kg: lower bound exclusive, upper bound inclusive.
WEIGHT_MIN_EXCLUSIVE = 0.1
WEIGHT_MAX_INCLUSIVE = 50.0
# Median used for weight imputation: quantile and relative error.
MEDIAN_QUANTILE = 0.5
MEDIAN_RELATIVE_ERROR = 0.01
# A delivery meets the SLA when it is delivered within this many seconds (inclusive).
SLA_SECONDS = 24 * 3600
# Couriers with fewer shipments than this are left out of the courier ranking.
MIN_SHIPMENTS_FOR_RANKING = 10
# Shipment status values.
STATUS_DELIVERED = "DELIVERED"
STATUS_INCIDENT = "INCIDENT"
STATUS_RETURNED = "RETURNED"
# Contract canonical values and the upper-cased variants mapped onto them;
# any other value is kept upper-cased, null stays null.
CONTRACT_CANON = {
    "EMPLOYEE": ("EMPLOYEE", "EMP"),
    "CONTRACTOR": ("CONTRACTOR",),
}
# Business columns that define an exact duplicate shipment (after cleaning).
SHIPMENT_KEY_COLUMNS = (
    "tracking_id", "pickup", "delivery", "city", "zip",
    "weight", "status", "courier_id", "client_type", "amount",
)
# Audit literals of the two raw sources: the names of their systems.
SHIPMENTS_SOURCE_FILE = "shipments.csv"
SHIPMENTS_SOURCE_SYSTEM = "shipment_tracking"
COURIERS_SOURCE_SYSTEM = "courier_registry"
# Number of rows shown by a preview.
PREVIEW_ROWS = 5
# Length of the top lists.
TOP_CITIES = 3
TOP_COURIERS = 10
# Field names of the courier JSON records, in the order of the raw courier columns.
COURIER_FIELDS = ("courier_id", "first_name", "last_name", "hire_date",
                  "contract", "assigned_city", "vehicle", "phone")
# Header names of the shipment CSV, in the order of the raw shipment columns.
SHIPMENT_FIELDS = ("tracking_id", "pickup_raw", "delivery_raw", "city", "zip",
                   "weight_raw", "status", "courier_id", "client_type", "amount_raw")
# Vocabulary of feeds written in Spanish: status values, contract canon, field
# names and the names of the source systems.
SPANISH_STATUS = ("ENTREGADO", "INCIDENCIA", "DEVUELTO")
SPANISH_CONTRACT_CANON = {
    "EMPLEADO": ("EMPLEADO", "EMP"),
    "AUTONOMO": ("AUTONOMO",),
}
SPANISH_COURIER_FIELDS = ("repartidor_id", "nombre", "apellido", "fecha_alta",
                          "tipo_contrato", "ciudad_asignada", "vehiculo", "telefono")
SPANISH_SHIPMENT_FIELDS = ("tracking_id", "fecha_recogida", "fecha_entrega", "ciudad", "codigo_postal",
                           "peso_kg", "estado", "repartidor_id", "cliente_tipo", "importe_envio")
SPANISH_SOURCE_SYSTEMS = ("sistema_tracking_v1", "sistema_rrhh_v2")
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class Vocabulary:
    """Values that name things in a feed: statuses, contract canon, field names, source systems."""

    delivered: str = STATUS_DELIVERED
    incident: str = STATUS_INCIDENT
    returned: str = STATUS_RETURNED
    contract_canon: dict = field(default_factory=lambda: dict(CONTRACT_CANON))
    courier_fields: tuple = COURIER_FIELDS
    shipment_fields: tuple = SHIPMENT_FIELDS
    shipments_system: str = SHIPMENTS_SOURCE_SYSTEM
    couriers_system: str = COURIERS_SOURCE_SYSTEM

    @property
    def canonical_contracts(self) -> tuple:
        return tuple(self.contract_canon)


ENGLISH = Vocabulary()
SPANISH = Vocabulary(*SPANISH_STATUS, contract_canon=dict(SPANISH_CONTRACT_CANON),
                     courier_fields=SPANISH_COURIER_FIELDS, shipment_fields=SPANISH_SHIPMENT_FIELDS,
                     shipments_system=SPANISH_SOURCE_SYSTEMS[0], couriers_system=SPANISH_SOURCE_SYSTEMS[1])
