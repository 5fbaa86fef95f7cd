"""Where reports lie: names beside the input, stored paths, settings files."""

from __future__ import annotations

import os
from pathlib import Path

SUFFIXES = {
    "ocr": ".ocr.json", "categories": ".categories.json", "category_review": ".category_review.json",
    "vlm": ".vlm.json", "matches": ".matches.json", "result": ".result.json",
}


def beside(path: str | Path, kind: str) -> Path:
    """The report of ``kind`` that belongs to an input or to another report of it."""
    path = Path(path)
    name = path.name
    for suffix in (*SUFFIXES.values(), path.suffix):
        if suffix and name.endswith(suffix):
            name = name[: -len(suffix)]
            break
    return path.with_name(name + SUFFIXES[kind])


def stem(path: str | Path) -> str:
    """A file's name without the suffix of its kind."""
    return beside(Path(path).name, "ocr").name.removesuffix(SUFFIXES["ocr"])


def auxiliary(inputs: list[str], kind: str, explicit: str | None = None) -> list[Path]:
    """Existing sibling reports of ``inputs``; an explicit one only with a single input."""
    if explicit is not None:
        if len(inputs) != 1:
            raise ValueError("an explicit auxiliary report needs exactly one input")
        if not Path(explicit).is_file():
            raise FileNotFoundError(explicit)
        return [Path(explicit)]
    return [p for p in (beside(i, kind) for i in inputs) if p.is_file()]


def stored(report: str | Path, path: str) -> Path:
    """A path named in a report: as it is, else beside the report."""
    for candidate in (Path(path), Path(report).parent / Path(path).name):
        if candidate.is_file():
            return candidate
    raise FileNotFoundError(f"{path} (named in {report})")


def read_env(path: str | Path) -> dict[str, str]:
    """KEY=value lines; blanks, # comments, ``export`` and matching quotes understood."""
    out: dict[str, str] = {}
    if not Path(path).is_file():
        return out
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        line = line.strip().removeprefix("export ").strip()
        key, eq, value = line.partition("=")
        if not eq or key.startswith("#"):
            continue
        value = value.strip()
        if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"":
            value = value[1:-1]
        out[key.strip()] = value
    return out


def secret(name: str, env_file: str | Path = ".env") -> str:
    """From the environment, else from the file. Pass it on by closure; it does not belong in a column or a setting."""
    value = os.environ.get(name) or read_env(env_file).get(name)
    if not value:
        raise ValueError(f"{name} is not set in the environment or in {env_file}")
    return value
