"""The run configuration: a JSON file that names genomes, reads and features, and the options of a run."""

from __future__ import annotations

import json
import warnings
from dataclasses import dataclass, field, replace
from pathlib import Path
from typing import Any

from locuslathe.errors import ConfigurationError, InputFileNotFoundError
from locuslathe.functions.names import CODINGS, FORMATS

# Options that a run and a file may set, and their accepted values
RUN_OPTIONS = ("threads", "validation_level", "logging_level", "type", "force_defragment_ref")
FILE_OPTIONS = ("threads", "validation_level")
LEVELS = ("strict", "trust", "minimal")
LOGGING = ("DEBUG", "INFO", "WARNING", "ERROR")
ORGANISMS = ("prokaryote", "eukaryote")
PLATFORMS = ("illumina", "ont", "pacbio")
ROLES = {
    "ref_genome": "ref_genome_filename", "mod_genome": "mod_genome_filename", "ref_plasmid": "ref_plasmid_filename",
    "mod_plasmid": "mod_plasmid_filename", "ref_feature": "ref_feature_filename", "mod_feature": "mod_feature_filename",
}
SEQUENCE_LIMIT = 5


@dataclass(frozen=True)
class Options:
    threads: int | None = None
    validation_level: str = "trust"
    logging_level: str = "INFO"
    type: str = "prokaryote"
    force_defragment_ref: bool = False

    def checked(self, given: dict[str, Any], allowed: tuple[str, ...] = RUN_OPTIONS) -> Options:
        """These options with the given ones in their place; unknown names and bad values raise."""
        unknown = set(given) - set(allowed)
        if unknown:
            raise ConfigurationError(f"unknown options: {', '.join(sorted(unknown))}")
        out = replace(self, **{k: v.upper() if k == "logging_level" and isinstance(v, str) else v for k, v in given.items()})
        if out.threads is not None and (isinstance(out.threads, bool) or not isinstance(out.threads, int) or out.threads < 1):
            raise ConfigurationError("threads must be a positive integer or null")
        for name, values in (("validation_level", LEVELS), ("logging_level", LOGGING), ("type", ORGANISMS)):
            if getattr(out, name) not in values:
                raise ConfigurationError(f"{name} must be one of {', '.join(values)}")
        if not isinstance(out.force_defragment_ref, bool):
            raise ConfigurationError("force_defragment_ref must be true or false")
        return out


@dataclass(frozen=True)
class InputFile:
    path: Path
    role: str
    options: Options
    fmt: str | None
    coding: str
    n_sequence_limit: int | None = None
    ngs_type: str | None = None


@dataclass(frozen=True)
class RunConfig:
    folder: Path
    options: Options
    files: dict[str, InputFile] = field(default_factory=dict)
    reads: tuple[InputFile, ...] = ()


def inside(folder: Path, name: str) -> Path:
    """The file ``name`` below ``folder``; anything that would lie elsewhere raises."""
    if "\0" in name:
        raise ConfigurationError("a path holds a null character")
    path = (folder / name).resolve()
    if Path(name).is_absolute() or not path.is_relative_to(folder.resolve()):
        raise ConfigurationError(f"{name} lies outside the configuration's folder")
    return path


def describe(path: Path) -> tuple[str | None, str]:
    """(format, coding) by the suffixes of a file name."""
    parts = path.name.lower().split(".")
    coding = CODINGS.get(parts[-1], "NONE") if len(parts) > 1 else "NONE"
    rest = parts[:-1] if coding != "NONE" else parts
    return (FORMATS.get(rest[-1]) if len(rest) > 1 else None), coding


def _file(folder: Path, value: Any, role: str, options: Options, **extra: Any) -> InputFile:
    entry = {"filename": value} if isinstance(value, str) else dict(value)
    if not isinstance(entry.get("filename"), str) or not entry["filename"]:
        raise ConfigurationError(f"{role} has no filename")
    path = inside(folder, entry["filename"])
    if not path.is_file():
        raise InputFileNotFoundError(str(path))
    limit = None
    if role.endswith("_genome"):
        limit = entry.get("n_sequence_limit", SEQUENCE_LIMIT)
        if isinstance(limit, bool) or not isinstance(limit, int) or limit < 1:
            raise ConfigurationError("n_sequence_limit must be a positive integer")
    extras = set(entry) - {"filename", "ngs_type", "n_sequence_limit", *FILE_OPTIONS}
    if extras or ("n_sequence_limit" in entry and limit is None):
        warnings.warn(f"{role}: ignored {', '.join(sorted(extras) or ['n_sequence_limit'])}", stacklevel=3)
    own = options.checked({k: entry[k] for k in FILE_OPTIONS if k in entry}, FILE_OPTIONS)
    fmt, coding = describe(path)
    return InputFile(path, role, own, fmt, coding, limit, **extra)


def load_config(path: str | Path, defaults: Options | None = None) -> RunConfig:
    """The checked configuration of a JSON file; its options come before ``defaults``, those of a file before its own."""
    path = Path(path)
    if not path.is_file():
        raise InputFileNotFoundError(str(path))
    try:
        raw = json.loads(path.read_text(encoding="utf-8"))
    except ValueError as e:
        raise ConfigurationError(f"{path} is no JSON: {e}") from e
    if not isinstance(raw, dict) or "ref_genome_filename" not in raw or "reads" not in raw:
        raise ConfigurationError("ref_genome_filename and reads are required")
    if not isinstance(raw["reads"], list) or not raw["reads"]:
        raise ConfigurationError("reads must be a list with at least one entry")
    options = (defaults or Options()).checked(raw.get("options") or {})
    files = {role: _file(path.parent, raw[key], role, options) for role, key in ROLES.items() if raw.get(key)}
    reads: list[InputFile] = []
    for entry in raw["reads"]:
        if not isinstance(entry, dict) or ("filename" in entry) == ("directory" in entry):
            raise ConfigurationError("a reads entry needs a filename or a directory")
        platform = entry.get("ngs_type", "illumina")
        if platform not in PLATFORMS:
            raise ConfigurationError(f"ngs_type must be one of {', '.join(PLATFORMS)}")
        if "filename" in entry:
            reads.append(_file(path.parent, entry, "reads", options, ngs_type=platform))
            continue
        folder = inside(path.parent, entry["directory"])
        if not folder.is_dir():
            raise InputFileNotFoundError(str(folder))
        own = {k: v for k, v in entry.items() if k != "directory"}
        for f in sorted(p for p in folder.iterdir() if p.is_file()):
            reads.append(_file(path.parent, own | {"filename": str(f.relative_to(path.parent.resolve()))}, "reads", options, ngs_type=platform))
    return RunConfig(path.parent, options, files, tuple(reads))


def load_params(path: str | Path) -> dict[str, Any]:
    """The run parameters that ``validation.run_parameters`` gave, read again from their JSON file."""
    return json.loads(Path(path).read_text(encoding="utf-8"))


def branches(params: dict[str, Any]) -> tuple[str, ...]:
    """The parts of a run that its parameters switch on; the merge of call tables always runs."""
    on = [p for p in ("illumina", "nanopore", "pacbio") if params.get(f"run_{p}")]
    if params.get("run_ref_x_mod") and int(params.get("contig_file_size") or 0) >= 1:
        on.insert(0, "assembly")
    return (*on, "merge")
