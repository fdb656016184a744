"""Settings of a run: explicit values, then TESSERA_ variables, then a .env file, then a TOML file, then defaults."""

from __future__ import annotations

import os
import tomllib
import typing
from dataclasses import dataclass, field, fields, replace
from pathlib import Path

PREFIX = "TESSERA_"


@dataclass(frozen=True)
class Config:
    """The settings' names and defaults."""

    annotations_path: str = "data/annotations.json"
    output_dir: str = "data/raw"
    timeout: int = 10
    #: Annotations to fetch in a shard; None for all.
    download_limit: int | None = None
    metadata_path: str = "data/metadata.parquet"
    annotated_path: str = "data/annotated.parquet"
    scene_graph_path: str = "data/scene_graphs.parquet"
    semantic_annotations_path: str = "data/semantic_annotations.parquet"
    filtered_download_path: str = "data/filtered_download.parquet"
    filtered_scene_path: str = "data/filtered_scene.parquet"
    min_image_pixels: int = 64 * 64
    min_scene_objects: int = 2
    annotate_limit: int | None = None
    overwrite: bool = False
    vlm_backend: str = "gemini"
    vlm_model: str = "gemini-2.0-flash"
    vlm_base_url: str = "http://localhost:8000/v1"
    vlm_prompt: str = "Describe this image in one concise sentence."
    concurrency: int = 8
    num_gpus_per_worker: float = 0
    verify: bool = True
    scene_ram_weights: str = "models/ram_plus_swin_large_14m.pth"
    scene_gdino_config: str = "models/GroundingDINO_SwinT_OGC.cfg.py"
    scene_gdino_weights: str = "models/groundingdino_swint_ogc.pth"
    scene_sam_weights: str = "models/sam_vit_h_4b8939.pth"
    scene_sam_type: str = "vit_h"
    scene_depth_model: str = "depth-anything/Depth-Anything-V2-Large-hf"
    scene_box_threshold: float = 0.30
    scene_text_threshold: float = 0.25
    scene_ram_image_size: int = 384
    scene_device: str = "cuda"
    gemini_api_key: str = field(default="", repr=False)
    openai_api_key: str = field(default="", repr=False)

    def but(self, **values: object) -> Config:
        """A copy with other values; None leaves a value as it is."""
        return replace(self, **{k: v for k, v in values.items() if v is not None})


def _typed(name: str, kind: object, value: object) -> object:
    """A value from a file or a variable in the field's type."""
    kinds = [k for k in typing.get_args(kind) or (kind,) if k is not type(None)]
    if value is None or (isinstance(value, str) and value == "" and len(typing.get_args(kind)) > 1):
        return None
    want = kinds[0]
    if want is bool and isinstance(value, str):
        low = value.strip().lower()
        if low not in {"1", "0", "true", "false", "yes", "no", "on", "off"}:
            raise ValueError(f"{name}: {value!r} is neither true nor false")
        return low in {"1", "true", "yes", "on"}
    if want in (int, float, str):
        return want(value)
    return value


def _env_file(path: Path) -> dict[str, str]:
    if not path.is_file():
        return {}
    lines = [line.strip().removeprefix("export ") for line in path.read_text().splitlines()]
    pairs = [line.split("=", 1) for line in lines if "=" in line and not line.startswith("#")]
    return {k.strip(): v.strip().strip("\"'") for k, v in pairs}


def load(toml: str | None = None, env_file: str = ".env", **values: object) -> Config:
    """Settings by priority; unknown names in the TOML file are an error."""
    kinds = typing.get_type_hints(Config)
    found: dict[str, object] = {}
    if toml and Path(toml).is_file():
        found |= tomllib.loads(Path(toml).read_text())
        if unknown := sorted(set(found) - set(kinds)):
            raise ValueError(f"unknown settings in {toml}: {unknown}")
    for source in (_env_file(Path(env_file)), os.environ):
        found |= {f.name: source[PREFIX + f.name.upper()] for f in fields(Config) if PREFIX + f.name.upper() in source}
    found |= {k: v for k, v in values.items() if v is not None}
    return Config(**{k: _typed(k, kinds[k], v) for k, v in found.items()})
