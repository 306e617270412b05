"""Settings: defaults, then a file's values, then those of the command line."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, fields, replace

TRUE = ("1", "true", "yes", "y", "on")
CHOICES = {"split_method": ("random", "scaffold", "stratified"), "endpoint_mapper": ("manual", "llm"), "ph_method": ("all", "hh", "emp", "mp"), "form": ("parquet", "csv", "named"), "task_type": (None, "regression", "classification")}


@dataclass(frozen=True)
class Settings:
    input_path: str | None = None
    base_dir: str | None = None
    output_path: str = "processed_data"
    scratch_path: str | None = None
    smiles_col: str = "SMILES_Structure_Parent"
    activity_col: str = "Measurement_Value"
    task_type: str | None = None
    threshold: float | None = None
    keep_stereo: bool = True
    keep_duplicates: bool = False
    detect_outliers: bool = False
    convert_units: bool = True
    correct_ph: bool = False
    ph_method: str = "all"
    target_ph: float = 7.4
    split: bool = False
    split_method: str = "random"
    test_size: float = 0.2
    valid_size: float = 0.1
    form: str = "parquet"
    to_matrix: bool = False
    endpoint_mapper: str = "manual"
    mapper_service: str | None = None
    answers_path: str | None = None
    mapping_path: str | None = None
    min_similarity: float = 0.55
    fill_missing: bool = False
    skip_preprocessing: bool = False
    dialect: str = "cli"

    def merged(self, values: Mapping) -> Settings:
        """These settings with values in place of their own; a name that is not known is an error."""
        kinds = {x.name: x.type for x in fields(self)}
        given = {k.replace("-", "_"): v for k, v in values.items() if v is not None}
        if unknown := sorted(set(given) - set(kinds)):
            raise ValueError(f"no such setting: {', '.join(unknown)}")
        new = replace(self, **{k: as_bool(v) if kinds[k] == "bool" else float(v) if kinds[k].startswith("float") else v for k, v in given.items()})
        for name, choices in CHOICES.items():
            if getattr(new, name) not in choices:
                raise ValueError(f"{name} must be one of {', '.join(choices)}")
        if not 0 <= new.test_size < 1 or not 0 <= new.valid_size < 1 or new.test_size + new.valid_size >= 1:
            raise ValueError("test and valid shares must leave something to train on")
        return new

    def as_dict(self) -> dict:
        return asdict(self)


def as_bool(value) -> bool:
    return value if isinstance(value, bool) else str(value).strip().lower() in TRUE


def from_arguments(arguments: Iterable[str]) -> dict[str, str | bool]:
    """--a-b v, --a-b=v, a_b=v and a bare --flag as names and values."""
    found: dict[str, str | bool] = {}
    waiting: str | None = None
    for word in arguments:
        if word.startswith("--") or waiting is None and "=" in word:
            if waiting is not None:
                found[waiting] = True
            name, given, value = word.lstrip("-").partition("=")
            waiting = None if given else name.replace("-", "_")
            if given:
                found[name.replace("-", "_")] = value
        elif waiting is not None:
            found[waiting] = word
            waiting = None
        else:
            raise ValueError(f"no setting before {word}")
    return found | ({waiting: True} if waiting is not None else {})


def from_file(path: str) -> dict:
    """A JSON file's values, or those of a flat YAML file (name: value)."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    if path.endswith(".json"):
        return json.loads(text)
    found = {}
    for line in text.splitlines():
        name, given, value = line.split(" #")[0].partition(":")
        if given and value.strip() and not name.strip().startswith("#"):
            value = value.strip().strip("'\"")
            found[name.strip()] = None if value in ("null", "~") else value
    return found


def load(path: str | None = None, arguments: Iterable[str] = ()) -> Settings:
    return Settings().merged(from_file(path) if path else {}).merged(from_arguments(arguments))
