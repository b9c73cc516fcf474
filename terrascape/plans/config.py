"""Analysis configurations: YAML to dataclasses, with every problem told at once."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from terrascape.functions.expr import ExpressionError, check_expression
from terrascape.functions.scalars import as_list

# Names of mask types, of watershed fields and of the configuration's keys.
TRAVEL_TIME, CONDITIONAL = "travel_time_population", "conditional_raster"
WATERSHED_FIELDS = ("HYBAS_ID", "NEXT_DOWN", "NEXT_SINK")
INPUT_PATHS = ("population_raster_path", "traveltime_raster_path", "dem_raster_path", "subwatershed_vector_path")
INPUT_NUMBERS = ("wgs84_pixel_size", "travel_time_pixel_size_m", "buffer_size_m")


@dataclass
class Mask:
    id: str
    type: str
    params: dict[str, Any] = field(default_factory=dict)


@dataclass
class Config:
    run_name: str
    work_dir: str
    output_dir: str
    paths: dict[str, Path]
    numbers: dict[str, float]
    aoi_patterns: list[str]
    full_extent: bool
    masks: list[Mask]
    combine: list[dict]
    log_level: str = "INFO"
    log_file: str = ""


class ConfigError(ValueError):
    pass


def _raise(title: str, problems: list[str]) -> None:
    if problems:
        raise ConfigError(title + "".join(f"\n  - {p}" for p in problems))


def load(path: str | Path) -> Config:
    """Read and check a configuration file; its ``run_name`` is its file's stem."""
    import yaml

    path = Path(path)
    return parse(yaml.safe_load(path.read_text(encoding="utf-8")) or {}, path.stem)


def parse(raw: dict, stem: str) -> Config:
    name = raw.get("run_name", "")
    if name != stem:
        raise ConfigError(f"run_name {name!r} is not the file's name {stem!r}")
    inputs = raw.get("inputs") or {}
    if not inputs:
        raise ConfigError("the inputs section is missing")
    full = inputs.get("analyze_full_raster_extent", False)
    if not isinstance(full, bool):
        raise ConfigError(f"analyze_full_raster_extent is true or false, not {full!r}")
    patterns = [p for p in as_list(inputs.get("aoi_vector_pattern")) if p]
    problems = []
    for key in INPUT_PATHS:
        value = inputs.get(key)
        if not value:
            problems.append(f"{key} is missing")
        elif not _there(value):
            problems.append(f"{key} does not exist: {value}")
    if full and patterns:
        problems.append("aoi_vector_pattern must be empty with analyze_full_raster_extent")
    if not full and not patterns:
        problems.append("aoi_vector_pattern is empty")
    problems += [f"{key} is missing" for key in INPUT_NUMBERS if inputs.get(key) is None]
    _raise("Inputs are missing:", problems)
    masks, combine = _sections(raw.get("sections") or [])
    logs = raw.get("logging") or {}
    return Config(name, raw.get("work_dir", ""), raw.get("output_dir", ""), {k: Path(inputs[k]) for k in INPUT_PATHS}, {k: float(inputs[k]) for k in INPUT_NUMBERS}, patterns, full, masks, combine, logs.get("level", "INFO"), logs.get("to_file", ""))


def _sections(sections: list) -> tuple[list[Mask], list[dict]]:
    masks, combine, problems, kinds = [], [], [], set()
    for k, section in enumerate(sections):
        if not isinstance(section, dict):
            problems.append(f"sections[{k}] is a {type(section).__name__}, not a mapping")
            continue
        present = {"masks", "combine"} & set(section)
        if not present:
            problems.append(f"sections[{k}] has neither masks nor combine")
        kinds |= present
        for what, out in (("masks", masks), ("combine", combine)):
            for j, item in enumerate(as_list(section.get(what))):
                if not isinstance(item, dict):
                    problems.append(f"sections[{k}].{what}[{j}] is a {type(item).__name__}, not a mapping")
                else:
                    out.append(Mask(item.get("id", ""), item.get("type", ""), item.get("params") or {}) if what == "masks" else item)
    if kinds != {"masks", "combine"}:
        raise ConfigError("sections need both masks and combine")
    ids = [m.id for m in masks]
    problems += [f"mask id {i!r} is used more than once" for i in sorted({i for i in ids if ids.count(i) > 1})]
    for m in masks:
        if m.type == TRAVEL_TIME:
            if "max_hours" not in m.params:
                problems.append(f"mask {m.id!r} needs max_hours")
        elif m.type == CONDITIONAL:
            try:
                check_expression(str(m.params.get("expression", "")))
            except ExpressionError as e:
                problems.append(f"mask {m.id!r}: {e}")
        else:
            problems.append(f"mask {m.id!r} has an unknown type {m.type!r}")
    problems += [f"combine logic {c.get('logic')!r} is not supported: only OR" for c in combine if str(c.get("logic", "OR")).upper() != "OR"]
    _raise("Sections are invalid:", problems)
    return masks, combine


def _there(path) -> bool:
    """Whether a local path exists; paths of other stores are told when Spark reads them."""
    return "://" in str(path) or os.path.exists(path)


def validate_paths(config: Config, fields: list[str] | None = None) -> None:
    """Existence of every path (patterns with wildcards are skipped), also of mask
    parameters that end in ``_path``; ``fields``: those of the watershed layer."""
    problems = []

    def check(value, label):
        if not value:
            problems.append(f"{label}: missing")
        elif not any(c in str(value) for c in "*?[") and not _there(value):
            problems.append(f"{label}: not found: {value}")

    for key, value in config.paths.items():
        check(value, key)
    for k, m in enumerate(config.masks):
        for key, value in m.params.items():
            if key.endswith("_path"):
                check(value, f"mask[{k}].params.{key}")
    if fields is not None and (lost := sorted(set(WATERSHED_FIELDS) - set(fields))):
        problems.append(f"subwatershed_vector_path: missing required fields: {', '.join(lost)}")
    _raise(f"{len(problems)} paths are invalid:", problems)


def describe(config: Config) -> str:
    """The configuration as text."""
    lines = [f"run: {config.run_name}", f"work_dir: {config.work_dir}", f"output_dir: {config.output_dir}"]
    lines += [f"{k}: {v}" for k, v in {**config.paths, **config.numbers}.items()]
    lines += [f"aoi: {p}" for p in config.aoi_patterns] or ["aoi: full raster extent"]
    lines += [f"mask {m.id} ({m.type}): {m.params}" for m in config.masks]
    return "\n".join([*lines, *[f"combine: {c}" for c in config.combine]])


def worker_count(config: Config, areas: int, cores: int) -> int:
    """Tasks worth running at once: a unit for each area and mask, two more where
    travel times are computed, at most the cores."""
    units = max(1, areas * len(config.masks))
    return min(units + (2 if any(m.type == TRAVEL_TIME for m in config.masks) else 0), cores)


@dataclass
class FocalArea:
    id: str
    path: str
    is_marine: bool
    buffer_m: float
    max_ha: float


def load_focal(path: str | Path) -> tuple[str, str, list[FocalArea]]:
    """The configuration of priority areas: the watershed layer, the output folder and
    the focal areas; relative paths start at the file's folder."""
    import yaml

    path = Path(path)
    raw = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
    place = lambda p: p if os.path.isabs(p) or "://" in p else str((path.parent / p).resolve())
    areas = [FocalArea(a["id"], place(a["path"]), bool(a["is_marine"]), float(a["buffer_distance_m"]), float(a["max_proposed_priority_area_ha"])) for a in raw["focal_vectors"]]
    return place(raw["aggregate_vector_path"]), place(raw["out_dir"]), areas
