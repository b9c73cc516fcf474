"""Configurations, one test for each error, and the file chunker."""

import copy
import json

import pytest

from terrascape.plans import cli, config
from terrascape.sources import chunks


@pytest.fixture
def good(tmp_path):
    for name in ("pop", "tt", "dem", "ws", "cond"):
        (tmp_path / name).write_text("x")
    p = lambda n: str(tmp_path / n)
    return {
        "run_name": "run",
        "inputs": {"wgs84_pixel_size": 0.1, "travel_time_pixel_size_m": 900, "buffer_size_m": 5000, "population_raster_path": p("pop"), "traveltime_raster_path": p("tt"), "dem_raster_path": p("dem"), "subwatershed_vector_path": p("ws"), "aoi_vector_pattern": "a/*.parquet"},
        "sections": [{"masks": [{"id": "a", "type": "travel_time_population", "params": {"max_hours": 2}}, {"id": "b", "type": "conditional_raster", "params": {"condition_raster_path": p("cond"), "expression": "value > 0"}}]}, {"combine": [{"logic": "OR"}]}],
    }


def test_good(good):
    c = config.parse(good, "run")
    assert c.aoi_patterns == ["a/*.parquet"] and [m.id for m in c.masks] == ["a", "b"] and c.numbers["buffer_size_m"] == 5000.0
    config.validate_paths(c, ["HYBAS_ID", "NEXT_DOWN", "NEXT_SINK"])
    assert "mask b" in config.describe(c) and config.worker_count(c, 3, 4) == 4 and config.worker_count(c, 0, 8) == 3


CASES = {
    "run_name": lambda c: c.update(run_name="other"),
    "inputs section": lambda c: c.update(inputs={}),
    "true or false": lambda c: c["inputs"].update(analyze_full_raster_extent="yes"),
    "dem_raster_path is missing": lambda c: c["inputs"].pop("dem_raster_path"),
    "dem_raster_path does not exist": lambda c: c["inputs"].update(dem_raster_path="/nowhere"),
    "must be empty": lambda c: c["inputs"].update(analyze_full_raster_extent=True),
    "aoi_vector_pattern is empty": lambda c: c["inputs"].update(aoi_vector_pattern=[""]),
    "buffer_size_m is missing": lambda c: c["inputs"].pop("buffer_size_m"),
    "not a mapping": lambda c: c["sections"].append("x"),
    "neither masks nor combine": lambda c: c["sections"].append({"z": 1}),
    "need both": lambda c: c["sections"].pop(),
    r"masks\[2\]": lambda c: c["sections"][0]["masks"].append("m"),
    r"combine\[1\]": lambda c: c["sections"][1]["combine"].append(3),
    "more than once": lambda c: c["sections"][0]["masks"].append(copy.deepcopy(c["sections"][0]["masks"][0])),
    "unknown type": lambda c: c["sections"][0]["masks"][0].update(type="z"),
    "needs max_hours": lambda c: c["sections"][0]["masks"][0].update(params={}),
    "not allowed": lambda c: c["sections"][0]["masks"][1]["params"].update(expression="open('x')"),
    "only OR": lambda c: c["sections"][1]["combine"][0].update(logic="AND"),
}


@pytest.mark.parametrize("message", CASES)
def test_errors(good, message):
    CASES[message](good)
    with pytest.raises(config.ConfigError, match=message):
        config.parse(good, "run")


def test_problems_are_told_together(good):
    good["inputs"].pop("dem_raster_path"), good["inputs"].pop("buffer_size_m")
    with pytest.raises(config.ConfigError, match=r"(?s)dem_raster_path.*buffer_size_m"):
        config.parse(good, "run")


def test_validate(good):
    c = config.parse(good, "run")
    c.masks[1].params["condition_raster_path"] = "/nowhere"
    c.masks[0].params["x_path"] = "some/*.tif"
    with pytest.raises(config.ConfigError, match=r"(?s)mask\[1\].params.condition_raster_path.*NEXT_DOWN"):
        config.validate_paths(c, ["HYBAS_ID", "NEXT_SINK"])


def test_yaml_files(good, tmp_path):
    yaml = pytest.importorskip("yaml")
    (tmp_path / "run.yaml").write_text(yaml.safe_dump(good))
    assert config.load(tmp_path / "run.yaml").run_name == "run"
    assert cli.main(["check", str(tmp_path / "run.yaml")]) == 0
    (tmp_path / "f.yaml").write_text(yaml.safe_dump({"aggregate_vector_path": "w", "out_dir": "/o", "focal_vectors": [{"id": "x", "path": "p", "is_marine": True, "buffer_distance_m": 5, "max_proposed_priority_area_ha": 9}]}))
    layer, out, areas = config.load_focal(tmp_path / "f.yaml")
    assert layer == str(tmp_path / "w") and out == "/o" and areas[0].is_marine and areas[0].max_ha == 9.0


@pytest.mark.parametrize("size", [0, 1, 4000, 8000, 8001])
def test_split_and_join(spark, tmp_path, size):
    data = bytes(k * 7 % 251 for k in range(size))
    (tmp_path / "f.bin").write_bytes(data)
    manifest = chunks.split_file(spark, tmp_path / "f.bin", tmp_path / "out", 4000)
    told = json.loads(manifest.read_text())
    assert told["total_parts"] == max(1, -(-size // 4000)) and sum(p["raw_size"] for p in told["parts"]) == size
    assert chunks.join_file(manifest, tmp_path / "back.bin").read_bytes() == data


def test_tampering_is_found(spark, tmp_path):
    (tmp_path / "f.bin").write_bytes(b"a" * 9000)
    manifest = chunks.split_file(spark, tmp_path / "f.bin", tmp_path / "out", 4000)
    told = json.loads(manifest.read_text())
    told["parts"][1]["raw_sha256"] = "0"
    manifest.write_text(json.dumps(told))
    with pytest.raises(ValueError, match="digest"):
        chunks.join_file(manifest, tmp_path / "b")
    chunks.join_file(manifest, tmp_path / "b", verify=False)
    (tmp_path / "out" / told["parts"][0]["zip_filename"]).unlink()
    with pytest.raises(FileNotFoundError, match="part000001"):
        chunks.join_file(manifest, tmp_path / "b")


def test_paths_of_other_stores_are_not_looked_for_locally(tmp_path):
    from terrascape.plans.config import _there

    assert _there("viewfs://store/in/pop") and _there(tmp_path) and not _there(tmp_path / "gone")
