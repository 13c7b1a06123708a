"""Settings: typed, with defaults, and overridable by the environment (QUIREWORK_<SECTION>_<NAME>)."""

from __future__ import annotations

import dataclasses
import os
import tomllib
from dataclasses import dataclass, field

#: The sections and limits of a volume configuration file.
SECTIONS = ("source", "crops", "coords", "transcripts", "crop", "api")
STALE_KEYS = {"crops": ("write_coords",)}
INSTRUCTION_LIMIT = 500


@dataclass(frozen=True)
class Quality:
    """Thresholds of the quality gates."""

    min_text_frac: float = 0.075
    min_orientation_conf: float = 0.70
    min_area_frac: float = 0.10
    aspect_low: float = 0.40
    aspect_high: float = 0.95
    blank: float = 0.5
    confirm_margin: float = 0.20
    override_margin: float = 0.35
    rescue_partial_spread: bool = False


@dataclass(frozen=True)
class Geometry:
    """How pages are cut out."""

    margin_frac: float = 0.045
    max_aspect: float = 2.4
    page_aspect: float = 0.80
    seam_relax: float = 0.02
    skew_limit: float = 15.0
    halves_overlap: float = 0.04
    prepass_conf: float = 0.5
    orient_margin: float = 0.15
    trim_border: bool = True
    tight_text: bool = False
    white_out: bool = False
    tight_box: bool = True
    dewarp: bool = False
    dewarp_curvature: float = 0.03
    #: Pages, masks and seams are found on a copy whose long side has so many pixels at most.
    find_size: int = 1500


@dataclass(frozen=True)
class Settings:
    quality: Quality = field(default_factory=Quality)
    geometry: Geometry = field(default_factory=Geometry)

    def to_dict(self) -> dict:
        return dataclasses.asdict(self)

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None, **explicit) -> Settings:
        """Environment over explicit values over defaults."""
        env = os.environ if env is None else env
        parts = {}
        for section in dataclasses.fields(cls):
            kind = section.default_factory
            values = dict(explicit.get(section.name, {}))
            for f in dataclasses.fields(kind):
                said = env.get(f"QUIREWORK_{section.name}_{f.name}".upper())
                if said is not None:
                    values[f.name] = said.lower() in ("1", "true", "yes") if isinstance(f.default, bool) else type(f.default)(said)
            parts[section.name] = kind(**values)
        return cls(**parts)


def load_volume_config(text: str) -> dict:
    """A volume configuration in TOML, checked: all sections, no keys of old versions, short instructions.

    A section without a profile of its own takes that of ``crops``."""
    config = tomllib.loads(text)
    if missing := [s for s in SECTIONS if s not in config]:
        raise ValueError(f"sections missing: {', '.join(missing)}")
    if stale := [f"{s}.{k}" for s, keys in STALE_KEYS.items() for k in keys if k in config[s]]:
        raise ValueError(f"no longer used: {', '.join(stale)}")
    for name, value in config["api"].items():
        if "instruction" in name and isinstance(value, str) and len(value) > INSTRUCTION_LIMIT:
            raise ValueError(f"api.{name} is longer than {INSTRUCTION_LIMIT} characters")
    for section in ("coords", "transcripts"):
        config[section]["profile"] = config[section].get("profile") or config["crops"].get("profile", "")
    return config
