"""A run's validation from its configuration to the parameters of the later steps.

    python -m locuslathe.run --config_json config.json --out_dir DIR [--hits mod_against_ref.paf]

Genomes, plasmids, reads and features are validated and written below the output folder, genomes and reads are checked
against each other, the modified genome's sequences are told apart as contigs and plasmids by their alignment hits, and
``report.txt``, ``report.json``, ``issues`` (JSON lines) and ``validated_params.json`` say what came of it. The aligner
itself is another program; without its hits nothing is told apart.
"""

from __future__ import annotations

import argparse
import time
from dataclasses import dataclass, replace
from datetime import datetime
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuslathe import validation as V
from locuslathe.errors import ValidationError
from locuslathe.operators import sequences as S
from locuslathe.session import build_session, temporary_tables
from locuslathe.sinks import files as K
from locuslathe.sinks import reports
from locuslathe.sources import sequences as SRC
from locuslathe.sources import tables as T
from locuslathe.sources.config import InputFile, RunConfig, load_config

#: What each file of a run is validated with.
SETTINGS: dict[str, V.Settings] = {
    "ref_genome": V.GenomeSettings(plasmids_to_one=True, output_filename_suffix="ref", replace_id_with_incremental="chr"),
    "mod_genome": V.GenomeSettings(output_filename_suffix="mod", replace_id_with_incremental="chr"),
    "ref_plasmid": V.GenomeSettings(is_plasmid=True, plasmids_to_one=True, output_filename_suffix="ref_plasmid"),
    "mod_plasmid": V.GenomeSettings(is_plasmid=True, plasmids_to_one=True, output_filename_suffix="mod_plasmid"),
    "ref_feature": V.FeatureSettings(sort_by_position=False, check_coordinates=False, replace_id_with="chr", output_filename_suffix="ref"),
    "reads": V.ReadSettings(coding_type="gz", outdir_by_ngs_type=True),
}
#: Files without which a run is of no use.
REQUIRED = ("ref_genome", "reads")


@dataclass(frozen=True)
class RunOptions:
    """The parameters of a run: where its configuration and its outputs lie, how many cores it may take."""

    config_json: str
    out_dir: str = "data/outputs"
    max_cpu: int = 1
    hits: str | None = None


def characterise(
    seqs: DataFrame, hits: DataFrame, folder: str, base: str, explicit: str | None = None, split: str | None = None
) -> dict[str, Any]:
    """Sequences with a hit become contigs, one file each, turned to the strand of their best hit; the others plasmids.

    Plasmids go behind those of the ``explicit`` file, else of the one ``split`` off the genome, else into a new file.
    ``seqs`` are those of a genome that isn't fragmented, so they are few.
    """
    best = S.best_hits(hits)
    contigs, plasmids = S.split_by_hit(seqs, best)
    turned = S.orient_by_hit(contigs, best)
    files = K.write_contig_files(turned.select("seq_idx", F.col("contig_base").alias("id"), F.lit("").alias("description"), "seq"), folder, base)
    told = turned.select("id", "ref_id").join(best.select(F.col("query").alias("id"), "strand"), "id").collect()
    n = plasmids.count()
    target = None
    if n:
        target = explicit or split or f"{folder}/{base}_plasmid.fasta"
        K.extend_fasta(plasmids, target)
    return {
        "contigs_found": len(files), "plasmids_found": n, "contig_files": files, "plasmid_file": target,
        "contig_orientations": {r["id"]: r["strand"] for r in told}, "contig_ref_names": {r["id"]: r["ref_id"] for r in told},
    }


def defragment(spark: SparkSession, file: InputFile, folder: Path) -> InputFile:
    """The reference as one merged sequence, with the order and places of its parts beside it; a stopgap, as warned about."""
    read = SRC.read_fasta if file.fmt == "FASTA" else SRC.read_genbank
    rows = read(spark, str(file.path)).drop("file")
    target = folder / f"{file.path.name.split('.', 1)[0]}_merged.fasta"
    merged = S.merge_contigs(rows, ()).withColumn("description", F.lit(""))
    K.as_file(lambda f: K.write_fasta(merged, f), target)
    K.write_offsets(S.contig_offsets(rows), str(folder / "contig_join_order"))
    return replace(file, path=target, fmt="FASTA", coding="NONE")


class _Run:
    def __init__(self, spark: SparkSession, config: RunConfig, out: Path) -> None:
        self.spark, self.config, self.out = spark, config, out
        self.results: list[dict[str, Any]] = []
        self.checks: list[dict[str, Any]] = []
        self.fatal: list[str] = []
        self.issues: list[DataFrame] = []

    def one(self, role: str, file: InputFile) -> V.Result | None:
        """The validated file, None if it failed; a required file that fails is a fatal error of the run."""
        settings = SETTINGS[role]
        kind, validate = {
            V.GenomeSettings: ("genome", V.validate_genome), V.ReadSettings: ("read", V.validate_reads),
            V.FeatureSettings: ("feature", V.validate_features),
        }[type(settings)]
        began = time.perf_counter()
        try:
            result = validate(self.spark, file, settings, out=self.out)
        except ValidationError as e:
            if role in REQUIRED:
                self.fatal.append(f"{role} validation failed: {e}")
            self.results.append({"validator_type": kind, "input_file": file.path.name, "settings": settings.to_dict(), "issues": [("ERROR", str(e))]})
            return None
        if role in REQUIRED and not result.metadata.get("output_file"):
            self.fatal.append(f"{role} validation produced no usable output file")
        result.metadata["elapsed_time"] = round(time.perf_counter() - began, 3)
        counts = []
        if result.issues is not None:
            named = result.issues.select(F.lit(file.path.name).alias("file"), "level", "message")
            counts = [(r["level"], f"{r['n']} in issues") for r in named.groupBy("level").agg(F.count(F.lit(1)).alias("n")).orderBy("level").collect()]
            self.issues.append(named)
        self.results.append({"validator_type": kind, "input_file": file.path.name, "settings": settings.to_dict(), "metadata": result.metadata, "issues": counts})
        return result

    def genomes(self, found: dict[str, V.Result | None], hits: str | None) -> None:
        ref, mod = found.get("ref_genome"), found.get("mod_genome")
        if ref is None or mod is None or ref.data is None or mod.data is None or mod.metadata.get("fragmented"):
            return
        check = V.check_genomes(ref.data, mod.data, False, False, False)
        if hits is not None:
            plasmid = found.get("mod_plasmid")
            names = mod.metadata.get("plasmid_filenames") or []
            target = Path(mod.metadata["output_file"])
            try:
                check["metadata"] |= characterise(
                    mod.data, T.read_paf(self.spark, hits), str(target.parent), target.name.split(".", 1)[0],
                    plasmid.metadata.get("output_file") if plasmid else None, str(target.parent / names[0]) if names else None,
                )
            except Exception as e:  # an unreadable table of hits fails the check, not the run
                check["errors"].append(f"Genome characterization skipped: {e}")
                check["passed"] = False
        self.checks.append(check | {"name": "genomexgenome"})


def validate_run(spark: SparkSession, options: RunOptions) -> dict[str, Any]:
    """Runs everything; returns the parameters that ``validated_params.json`` holds. A bad configuration raises."""
    began, config, out = time.perf_counter(), load_config(options.config_json), Path(options.out_dir)
    run = _Run(spark, config, out)
    files = dict(config.files)
    if config.options.force_defragment_ref:
        files["ref_genome"] = defragment(spark, files["ref_genome"], out)
        files.pop("ref_feature", None)  # places on the parts mean nothing on the whole
    with temporary_tables():
        found = {role: run.one(role, files[role]) for role in SETTINGS if role in files}
        run.genomes(found, options.hits)
        reads = [r for f in config.reads if (r := run.one("reads", f)) is not None]
        pairs = [r for r in reads if r.metadata.get("input_format") == "FASTQ"]
        if pairs:
            run.checks.append(V.check_reads(spark, pairs) | {"name": "readxread"})
        issues = spark.createDataFrame([], "file string, level string, message string")
        for own in run.issues:
            issues = issues.unionByName(own)
        K.write_audit(issues, str(out / "issues"))
    seconds = round(time.perf_counter() - began, 3)
    K.write_text(reports.validation_report(run.results, run.checks, run.fatal), K.next_path(out / "report.txt"))
    K.write_text(reports.report_json(run.results, run.checks, run.fatal, seconds), K.next_path(out / "report.json"))

    def path(role: str) -> str | None:
        return found[role].metadata.get("output_file") if found.get(role) else None

    def split(role: str) -> list[str]:
        r = found.get(role)
        names = (r.metadata.get("plasmid_filenames") or []) if r else []
        return [str(Path(r.metadata["output_file"]).parent / n) for n in names] if names and r.metadata.get("output_file") else []

    told = next((c for c in run.checks if c["name"] == "genomexgenome"), {"passed": False, "metadata": {}})
    params = V.run_parameters(
        {
            "ref": path("ref_genome"), "mod": path("mod_genome"), "ref_plasmid": path("ref_plasmid"), "mod_plasmid": path("mod_plasmid"),
            "ref_split": split("ref_genome"), "mod_split": split("mod_genome"),
            "characterised_plasmid": told["metadata"].get("plasmid_file"), "contigs": told["metadata"].get("contig_files"),
        },
        [r.metadata for r in reads if r.metadata.get("output_file")],
        bool(told["passed"]),
        any(found[r] and found[r].metadata.get("fragmented") for r in ("ref_genome", "mod_genome") if r in found),
    ) | {"validation_timestamp": datetime.now().strftime("%Y%m%d_%H%M%S")}
    K.write_text(K.params_json(params), out / "validated_params.json")
    return params | {"fatal_errors": run.fatal}


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--config_json", required=True)
    p.add_argument("--out_dir", default="data/outputs")
    p.add_argument("--max_cpu", type=int, default=1)
    p.add_argument("--hits")
    a = p.parse_args(args)
    options = RunOptions(a.config_json, a.out_dir, a.max_cpu, a.hits)
    spark = build_session("validation", f"local[{options.max_cpu}]")
    try:
        return 1 if validate_run(spark, options)["fatal_errors"] else 0
    except ValidationError as e:
        print(f"{type(e).__name__}: {e}")
        return 1


if __name__ == "__main__":
    raise SystemExit(main())
