"""Deterministic dirty feed derived from the TPC-H style test tables.

The shipment feed is one row per line item (plus exact copies), the courier
feed one row per supplier (plus copies). Every defect is switched on by a
hex prefix of ``md5(key:rule)``, so the same rows are dirty in every engine
and at every partitioning. Copies are produced with ``explode`` in the same
pass as the source rows (no second scan, no union of two plans).

Shares of each defect (fixed values of the feed):

* null weight 8/256 (per shipment, so copies agree), out-of-range weight
  0x148/65536, decimal comma 4/256, European pickup 0x1a/256, noisy city
  0x0e/256, zip without its leading zero 0x0b/256 when it starts with 0,
  unknown courier 0x28f/65536, exact copies 0x51f/65536 of shipments
  (dirtied independently afterwards), copies 0x0d/256 of couriers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lastmile.sources.tables import read_table

# --- fixed values of the feed ----------------------------------------------
EU_FORMAT = "dd/MM/yyyy HH:mm:ss"
ISO_FORMAT = "yyyy-MM-dd HH:mm:ss"
ABSURD_WEIGHTS = ("-0.5", "0.0", "75.5", "640.0")
#: First postal code, the step from part to part and the number of codes.
ZIP_FIRST, ZIP_STEP, ZIP_COUNT = 1000, 37, 90000
ASSIGNED_CITIES = ("Automobile", "Building", "Furniture", "Household", " Machinery ")
# --- end of fixed values ----------------------------------------------------


def _hex(key: str, rule: str, digits: int = 2) -> str:
    """SQL text: the first ``digits`` hex characters of ``md5(key || ':rule')``."""
    return f"substring(md5(concat({key}, ':{rule}')), 1, {digits})"


def _courier_key(sk: str) -> str:
    """SQL text: ``REP-`` + the supplier key left-padded to at least 5 digits (never cut)."""
    return (f"concat('REP-', if(length(cast({sk} as string)) < 5, "
            f"lpad(cast({sk} as string), 5, '0'), cast({sk} as string)))")


def _unknown_courier_key(sk: str) -> str:
    """SQL text: an id no courier can have (real ids are all digits after ``REP-``)."""
    return f"concat('REP-X', lpad(cast({sk} % 100 as string), 4, '0'))"


def _after(ts: str, hours: str, minutes: str) -> str:
    return f"{ts} + make_dt_interval(0, cast({hours} as int), cast({minutes} as int), 0)"


def _copy_hashes(copy: int) -> str:
    """SQL text: copy number and the filtered-on hash prefixes of one copy (key ``k#copy``)."""
    kc = f"concat(k, '#{copy}')"
    fields = ", ".join(f"'{rule}', {_hex(kc, rule, digits)}"
                       for rule, digits in (("bad", 4), ("com", 2), ("fk", 4)))
    return f"named_struct('copy', {copy}, {fields})"


def shipment_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw shipment rows (all strings), like a CSV export of the tracking system.

    The row expressions are SQL text (``selectExpr``): the plan is the same as
    with Column objects, built with a few calls instead of hundreds.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_quantity", "l_extendedprice", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    # Segment per order first (orders x customer, customer may be broadcast when
    # small), then the line items. Orders grow with line items, so that join is a
    # sort-merge join on the order key; the feed expressions run in its partitions.
    order_seg = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        "o_orderkey", "c_mktsegment")
    b = li.join(order_seg.hint("merge"), li.l_orderkey == order_seg.o_orderkey)

    keyed = b.selectExpr(
        "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), cast(l_partkey as string), "
        "cast(l_suppkey as string), cast(to_date(l_shipdate) as string)) as k",
        "l_orderkey as ok", "l_linenumber as ln", "l_partkey as pk", "l_suppkey as sk", "c_mktsegment as seg",
        "cast(l_quantity * 0.5D as string) as w",
        "cast(l_extendedprice as string) as amount_raw",
        _after("l_shipdate", "8 + l_orderkey % 11", "l_partkey % 60") + " as pickup")
    base = keyed.selectExpr(
        "k", "pk", "sk", "seg", "w", "amount_raw", "pickup",
        _after("pickup", "4 + (pk * 7 + ln) % 33", "ok % 60") + " as delivery",
        f"case when {_hex('k', 'st')} < 'd9' then 'DELIVERED' when {_hex('k', 'st')} < 'f3' then 'INCIDENT' "
        "else 'RETURNED' end as status",
        f"case when {_hex('k', 'cl')} < 'b3' then 'PERSON' else 'COMPANY' end as client_type",
        f"lpad(cast({ZIP_FIRST} + (pk * {ZIP_STEP} + length(seg)) % {ZIP_COUNT} as string), 5, '0') as zip5",
        f"{_hex('k', 'wn')} as h_wn",
        # one struct per copy (0, plus 1 for a duplicated shipment) with the hash
        # prefixes behind the columns that later filters read (weight range,
        # known courier): those filters then read struct fields instead of
        # re-evaluating the hashes; the other prefixes are computed after the
        # explode, where column pruning drops them when unused
        f"if({_hex('k', 'dup', 4)} < '051f', array({_copy_hashes(0)}, {_copy_hashes(1)}), "
        f"array({_copy_hashes(0)})) as copies")
    # explode_outer: the arrays are never empty, and no size() filter is pushed to the scan
    c = base.selectExpr("*", "explode_outer(copies) as h").drop("copies")
    kc = "concat(k, '#', cast(h.copy as string))"
    absurd = " ".join(f"when {i} then '{v}'" for i, v in enumerate(ABSURD_WEIGHTS))
    return c.selectExpr(
        "k as tracking_id",
        f"if({_hex(kc, 'eu')} < '1a', date_format(pickup, '{EU_FORMAT}'), "
        f"date_format(pickup, '{ISO_FORMAT}')) as pickup_raw",
        f"if(status = 'DELIVERED', date_format(delivery, '{ISO_FORMAT}'), null) as delivery_raw",
        # the usual case first, so that most rows are hashed once; a postal code without
        # a leading zero needs no hash
        f"case when {_hex(kc, 'city')} >= '0e' then concat(substring(seg, 1, 1), lower(substring(seg, 2))) "
        f"when {_hex(kc, 'city')} < '07' then lower(seg) else concat('  ', seg, '  ') end as city",
        f"if(startswith(zip5, '0') and {_hex(kc, 'zip')} < '0b', substring(zip5, 2), zip5) as zip",
        f"case when h.bad < '0148' then case pk % 4 {absurd} end "
        "when h_wn < '08' then cast(null as string) "
        "when h.com < '04' then replace(w, '.', ',') else w end as weight_raw",
        "status",
        f"if(h.fk < '028f', {_unknown_courier_key('sk')}, {_courier_key('sk')}) as courier_id",
        "client_type",
        "amount_raw",
    )


def courier_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw courier records (all strings), like a JSON Lines export of the HR system."""
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    keyed = sup.selectExpr(f"{_courier_key('s_suppkey')} as k", "s_suppkey as sk", "s_name", "s_nationkey as nk")
    city = " ".join(f"when {i} then '{c}'" for i, c in enumerate(ASSIGNED_CITIES[:-1]))
    rows = keyed.selectExpr(
        "k as courier_id",
        "if(sk % 7 = 0, concat(' ', s_name, ' '), s_name) as first_name",
        "concat('Family ', cast(nk as string)) as last_name",
        "concat_ws('-', cast(2019 + sk % 5 as string), lpad(cast(1 + sk % 12 as string), 2, '0'), "
        "lpad(cast(1 + sk % 28 as string), 2, '0')) as hire_date",
        f"case when {_hex('k', 'cv')} < '10' then "
        "case when sk % 5 < 3 then case sk % 3 when 0 then 'employee' when 1 then 'Employee' else 'EMP' end "
        "else 'contractor' end "
        "when sk % 5 < 3 then 'EMPLOYEE' else 'CONTRACTOR' end as contract",
        f"case sk % 5 {city} else '{ASSIGNED_CITIES[-1]}' end as assigned_city",
        "case when sk % 20 < 10 then 'VAN' when sk % 20 < 17 then 'MOTO' else 'BIKE' end as vehicle",
        f"if({_hex('k', 'ph')} < '1a', cast(null as string), concat('+34 6', lpad(cast(sk as string), 8, '0'))) "
        "as phone",
        f"if({_hex('k', 'dup')} < '0d', array(0, 1), array(0)) as copies")
    return rows.selectExpr("*", "explode_outer(copies) as _copy").drop("copies", "_copy")


def broken_shipment_lines(shipments: DataFrame) -> DataFrame:
    """``line`` and ``reason``: CSV lines that are no shipments, six of 256 rows' worth."""
    h = _hex("tracking_id", "broken")
    picked = shipments.selectExpr("*", f"{h} as h").where("h < '06'")
    return picked.selectExpr(
        "case when h < '02' then concat_ws(',', tracking_id, pickup_raw, status, courier_id) "
        "when h < '04' then concat_ws(',', tracking_id, pickup_raw, 'x', 'X', '00000', '1', status, courier_id, client_type, amount_raw, 'surplus') "
        "else concat(tracking_id, ',\"', pickup_raw, ',x,X,00000,1,', status, ',', courier_id, ',', client_type, ',', amount_raw) end as line",
        "case when h < '02' then 'short_line' when h < '04' then 'long_line' else 'unclosed_quote' end as reason")


def broken_courier_lines(couriers: DataFrame) -> DataFrame:
    """``line`` and ``reason``: JSON lines that are no couriers, for half of the rows."""
    picked = couriers.selectExpr("*", f"{_hex('courier_id', 'broken')} as h").where("h < '80'")
    return picked.selectExpr(
        "case when h < '20' then concat('{\"courier_id\":\"', courier_id, '\",\"first_name\":') "
        "when h < '40' then concat(courier_id, ';', vehicle) "
        "when h < '60' then concat('[\"', courier_id, '\"]') "
        "else concat('{\"vehicle\":\"', vehicle, '\"}') end as line",
        "case when h < '40' then 'broken_json' when h < '60' then 'not_an_object' else 'no_key' end as reason")
