import json
import os
import uuid

from lastmile.__main__ import main
from conftest import SF_SMALL


def test_command_line_runs_every_layer(spark, scratch_dir, capsys):
    root = os.path.join(scratch_dir, f"cli-{uuid.uuid4().hex[:8]}")
    main(["--root", root, "--feed", SF_SMALL, "--median", "exact"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["bronze"] == {"shipments": 6119, "couriers": 10}
    assert out["silver"]["silver_rows"] == 5915
    for layer in ("bronze", "silver", "gold", "export"):
        assert os.path.isdir(os.path.join(root, layer))
