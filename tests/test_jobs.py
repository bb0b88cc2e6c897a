"""The submitted jobs, one after the other: layers, monitors and words."""

from __future__ import annotations

import json
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

from millrace.jobs import arguments, run
from millrace.session import shared_dir
from millrace.sinks.committed import committed
from millrace.sinks.text import read_snapshot


def reading(at: str, device: int, value: float, fail: bool = False) -> str:
    return json.dumps(dict(time=at, DeviceId=device, sensor1=value, sensor2=1.0, sensor3=1.0, motor1=1.0, motor2=1.0,
                           motor3=1.0, isFail=fail, collected_at=at))


@pytest.mark.parametrize("separate", [False, True])
def test_layers_then_monitors(spark, rows, separate):
    source, root, out = (shared_dir(spark, name) for name in ("in", "layers", "out"))
    messages = [
        reading("2024-01-01T11:20:00", 1, 150.0),
        reading("2024-01-01T11:40:00", 1, 151.0),
        reading("2024-01-01T12:10:00", 1, 152.0),
        reading("2024-01-01T12:10:00", 1, 152.0),
        reading("2024-01-01T12:31:00", 1, 153.0),
        reading("2024-01-01T11:59:00", 2, 9.0),
        reading("2024-01-01T12:05:00", 1, 1.0),
        reading("2024-01-01T12:15:00", 1, 2.0),
        reading("2024-01-01T12:20:00", 1, 3.0, fail=True),
    ]
    rows([(m,) for m in messages], "value string").coalesce(1).write.text(source)
    layout = ["--separate"] if separate else []
    run(spark, ["layers", root, "--format", "text", "--path", source, "--trigger", "once", "--state-partitions", "2", *layout])
    assert committed(spark, root)["last"]
    run(spark, ["monitor", root, f"{out}-m", "--layer", "data", "--as-of", "2024-01-01T12:30:00", "--prefix", "p_", *layout])
    got = {(r["metric"], r["device_id"]): r["value"] for r in read_snapshot(spark, f"{out}-m").collect()}
    assert got["p_sensor1", "1"] == 2.0 and len(got) == 6
    run(spark, ["errors", root, f"{out}-e", "--as-of", "2024-01-01T12:30:00", "--text", *layout])
    assert read_snapshot(spark, f"{out}-e", "text").first()["value"] == 'error_count_per_hour{device_id="1"} 2.0'


def test_archive_and_words(spark, rows):
    source, out = shared_dir(spark, "in"), shared_dir(spark, "out")
    rows([("1",), ("[2]",), ("x y x",)], "value string").coalesce(1).write.text(source)
    run(spark, ["archive", f"{out}-a", "--format", "text", "--path", source, "--trigger", "once"])
    assert sorted(r["value"] for r in spark.read.text(f"{out}-a").select("value").collect()) == ["1", "[2]"]
    run(spark, ["words", source, f"{out}-w"])
    assert sorted(r["value"] for r in spark.read.text(f"{out}-w").collect()) == ["1\t1", "[2]\t1", "x\t2", "y\t1"]


def test_topic_options():
    args = arguments().parse_args(["layers", "r", "--option", "subscribe=a", "--option", "kafka.bootstrap.servers=h:1=2"])
    assert dict(args.option) == {"subscribe": "a", "kafka.bootstrap.servers": "h:1=2"} and args.trigger == "30 seconds"


class Elsewhere:
    """A session whose master is another."""

    def __init__(self, spark, master, **conf):
        self._jvm, self._jsc, self.conf = spark._jvm, spark._jsc, SimpleNamespace(get=lambda key, *_: conf.get(key))
        self.sparkContext = SimpleNamespace(master=master)


def test_tables_do_not_go_to_a_folder_of_one_machine(spark, tmp_path):
    local = {"spark.sql.warehouse.dir": f"file:{tmp_path}"}
    for master in ("local", "local[4]", "local[*]"):
        assert shared_dir(Elsewhere(spark, master, **local), "t").startswith(f"file:{tmp_path}/shared/t-")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_dir(Elsewhere(spark, master, **local), "t")
        assert shared_dir(Elsewhere(spark, master, **local, **{"spark.checkpoint.dir": "file:/mnt/all/"}), "t").startswith("file:/mnt/all/t-")


def test_other_queries_stay_without_the_training_data_libraries():
    """As where the subpackage, or a library that only it needs, is not there."""
    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op') for k in e.queries()))"
    root = Path(__file__).resolve().parents[1]
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120, check=True)
    assert done.stdout.split()[1] == "False" and int(done.stdout.split()[0]) > 70
