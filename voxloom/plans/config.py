"""Filter configurations: YAML sections by name."""

from __future__ import annotations

import warnings


def read_config(path: str, name: str | None = None) -> dict:
    """The named section; ``default`` with a warning where there is none of that name; an error without a default."""
    import yaml

    with open(path) as f:
        sections = yaml.safe_load(f) or {}
    if name is not None and name in sections:
        return sections[name] or {}
    if name not in (None, "default"):
        warnings.warn(f"no filter configuration {name}; the default is taken", stacklevel=2)
    if "default" not in sections:
        raise ValueError(f"{path} has no section default")
    return sections["default"] or {}


#: Fixed values of the shipped default.
DEFAULT = {
    "sample_rate": 44100,
    "channels": 1,
    "duration": {"min": 1, "max": 15},
    "use_unknown_speakers": False,
    "only_with_ASR_texts": False,
    "only_with_Original_texts": False,
}
