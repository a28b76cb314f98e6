"""The whole run: FASTQ pairs to normalised matrices, each stage a table that a later run finds again.

Beside a stage's table stands a small file with a digest of all that went into it (its
settings, the sheets, the sequencing files and the stages before it) and the numbers
gathered while it was written.  A stage is found again only if its digest is the same.
"""

from __future__ import annotations

import configparser
import hashlib
import json

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spindrift.functions.seq import BASES, field, has_repeat, n_count, split_fields
from spindrift.operators import barcodes as B
from spindrift.operators import matrix as M
from spindrift.sources import files
from spindrift.sources.fastq import locate

STEPS = ("reads", "aggregated", "filtered", "readtable", "collapsed", "vbctable", "vbcfiltered", "matrices")
#: The settings that each stage depends on, by section; None: all of it.
USES = {
    "reads": {"fastq": ("r1start", "r1end", "r2start", "r2end", "source_regex", "filter_by_non_dominant", "filter_by_sampleinfo_ssi", "filter_column", "ourtube_regex"), "split": ("ssi_st", "ssi_end")},
    "aggregated": {"fastq": ("min_reads",)},
    "filtered": {"fastq": ("max_repeats", "max_n_bases"), "split": None},
    "readtable": {"readtable": None, "vbcfilter": ("include_lone",)},
    "collapsed": {"collapse": None},
    "vbctable": {"vbctable": None},
    "vbcfiltered": {"vbcfilter": None},
    "matrices": {},
}


class Watch:
    """Numbers gathered by the job that writes a stage, under the paths of the stats tree."""

    def __init__(self) -> None:
        self.held: list[tuple[str, Observation]] = []
        self.known: dict = {}

    def add(self, path: str, key: str, value) -> None:
        files.add_stat(self.known, path, key, value)

    def on(self, df: DataFrame, path: str, **numbers: Column) -> DataFrame:
        """``df``, which counts as it is read; its plan goes into the written stage once."""
        seen = Observation()
        self.held.append((path, seen))
        return df.observe(seen, *[c.alias(k) for k, c in numbers.items()])

    def tree(self) -> dict:
        """All numbers, once the stage is written."""
        for path, seen in self.held:
            for k, v in seen.get.items():
                files.add_stat(self.known, path, k, v)
        return self.known


def _rows() -> Column:
    return F.count(F.lit(1))


class Run:
    """One run's inputs, settings and folder, and the stages made or found so far."""

    def __init__(self, spark: SparkSession, cp: configparser.ConfigParser, pairs: list[tuple[str, str]], samples: DataFrame, barcodes: DataFrame, folder: str):
        self.spark, self.cp, self.pairs, self.samples, self.barcodes, self.folder = spark, cp, pairs, samples, barcodes, folder
        self.out: dict[str, DataFrame] = {}
        self.stats: dict = {}
        self.made: list[str] = []

    # --- what went into a stage ---

    def _inputs(self, step: str):
        if step == "reads":
            infos = [fs.get_file_info(at) for pair in self.pairs for fs, at in map(locate, pair)]
            if missing := [p for p, x in zip([f for pair in self.pairs for f in pair], infos) if x.type != pafs.FileType.File]:
                raise FileNotFoundError(", ".join(missing))
            used = [[p for pair in self.pairs for p in pair], [(x.size, x.mtime_ns) for x in infos]]
            return used + (self._inputs("readtable") if self.cp["fastq"].getboolean("filter_by_sampleinfo_ssi") else [])
        if step in ("readtable", "vbctable", "matrices"):  # sheets: one row a sample or barcode
            return [sorted(df.toJSON().collect()) for df in (self.samples, self.barcodes)]
        return None

    def digest(self, step: str, before: str) -> str:
        used = {name: {k: v for k, v in sorted(self.cp[name].items()) if keys is None or k in keys} for name, keys in USES[step].items()}
        return hashlib.sha256(json.dumps([step, before, used, self._inputs(step)]).encode()).hexdigest()

    # --- stages ---

    def reads(self, watch: Watch) -> DataFrame:
        fq = self.cp["fastq"]
        ends = lambda r: (fq.getint(f"{r}start"), fq.getint(f"{r}end"))
        df = files.read_fastq_pairs(self.spark, self.pairs, ends("r1"), ends("r2"), r"([^/]+)$", number=True).withColumn("source", F.regexp_extract("source", "^" + fq["source_regex"], 1))
        watch.add("/fastq", "pairs_handled", len(self.pairs))
        df = watch.on(df, "/fastq", **{f"pair{i + 1}_len": F.count_if(F.col("pair_id") == i) for i in range(len(self.pairs))})
        column = fq["filter_column"]
        bounds = [fq.getint(f"{column}{end}", self.cp["split"].getint(f"{column}{end}", 0)) for end in ("_st", "_end")]
        if fq.getboolean("filter_by_non_dominant") or fq.getboolean("filter_by_sampleinfo_ssi"):
            df = df.withColumn(column, field(F.col("sequence"), *bounds))
        if fq.getboolean("filter_by_non_dominant"):
            df = B.keep_dominant(df, "pair_id", column)
        if fq.getboolean("filter_by_sampleinfo_ssi"):
            named = self.spark.createDataFrame([(i, p[0].rsplit("/", 1)[-1]) for i, p in enumerate(self.pairs)], "pair_id int, name string")
            tubes = named.select("pair_id", F.regexp_extract("name", "^" + fq["ourtube_regex"], 1).alias("ourtube"))
            df = B.keep_sheet_ssi(df.join(F.broadcast(tubes), "pair_id"), self.samples, self.barcodes, column)  # one row a pair
        return watch.on(df.select("sequence", "source"), "/fastq", reads_handled=_rows())

    def aggregated(self, watch: Watch) -> DataFrame:
        return watch.on(B.aggregate_reads(self.out["reads"], min_reads=self.cp["fastq"].getint("min_reads")), "/aggregated", n_sequences=_rows())

    def filtered(self, watch: Watch) -> DataFrame:
        fq, sp = self.cp["fastq"], self.cp["split"]
        most, most_n, s = fq.getint("max_repeats"), fq.getint("max_n_bases"), F.col("sequence")
        df = watch.on(self.out["aggregated"], "/fastq_filter", num_initial=_rows(), num_has_repeats=F.count_if(has_repeat(s, most)), num_has_n=F.count_if(n_count(s) > most_n))
        df = watch.on(df, "/fastq", **{f"n_repeat_{b}": F.count_if(s.contains(b * (most + 1))) for b in BASES})
        watch.add("/fastq_filter", "max_repeats", most)
        df = watch.on(B.filter_reads(df, max_repeats=most, max_n_bases=most_n), "/fastq_filter", num_kept=_rows())
        return split_fields(df, [(c, sp.getint(f"{c}_st"), sp.getint(f"{c}_end")) for c in ("vbc_read", "spikeseq", "libtag", "umi", "ssi")])

    def readtable(self, watch: Watch) -> DataFrame:
        rt = self.cp["readtable"]
        use_libtag = rt.getboolean("use_libtag")
        use_lone, by_libtag = use_libtag and rt.getboolean("use_lone"), use_libtag and rt.getboolean("filter_by_libtag")
        used = self.barcodes.join(self.samples.select("label").distinct(), "label", "left_semi")
        full = B.classify(B.lookup_samples(self.out["filtered"], used, self.samples), rt["spikeseq"], rt["realregex"], rt["loneregex"] if rt.getboolean("use_lone") else "(?!)", use_libtag, not rt.getboolean("filter_by_libtag"))
        known = F.col("label").isNotNull()
        switched = known & F.coalesce(B.is_template_switch(), F.lit(False)) if use_lone else F.lit(False)
        lone = known & ~switched & F.coalesce(F.col("type") == "lone", F.lit(False)) if use_lone else F.lit(False)
        gone = lone & F.lit(not self.cp["vbcfilter"].getboolean("include_lone"))
        bad = known & ~switched & ~gone & (F.col("site").isNull() | F.col("type").isNull()) if by_libtag else F.lit(False)
        kept = known & ~switched & ~gone & ~bad
        rejected = {"bad_ssi": full.where(~known).drop("type")}
        if use_libtag:
            rejected["libtag_counts"] = full.where(known).groupBy("libtag").agg(_rows().alias("count"))
        if use_lone:
            rejected |= {"template_switch": full.where(switched), "valid_lones": full.where(lone)}
        if by_libtag:
            rejected["bad_type"] = full.where(bad)
        files.write_frames(rejected, f"{self.folder}/rejected")
        flags = {"n_badssi": ~known} | ({"n_tswitch": switched, "n_lones": lone} if use_lone else {}) | ({"n_badtype": bad} if by_libtag else {}) | {"n_full_sequences": kept, "n_final": kept}
        return watch.on(full, "/readtable", n_initial=_rows(), **{k: F.count_if(c) for k, c in flags.items()}).where(kept).drop("ssi", "spikeseq")

    def _brains(self) -> list[str]:
        return sorted(r[0] for r in self.samples.select("brain").where("brain <> ''").distinct().collect())  # the sheet's brains

    def collapsed(self, watch: Watch) -> DataFrame:
        co = self.cp["collapse"]
        numbers = {"sequences": ("n_unique_sequences", F.lit(True)), "edges": ("n_edges", F.lit(True)), "components": ("n_multi_components", F.col("seq") == F.col("comp"))}

        def seen(name: str, df: DataFrame) -> DataFrame:
            key, counted = numbers[name]
            for b in self._brains():
                df = watch.on(df, f"/collapse/brain_{b}", **{key: F.count_if((F.col("grp") == b) & counted)})
            return df

        df = B.align_collapse(self.out["readtable"], max_distance=co.getint("max_mismatch"), min_reads=co.getint("min_reads"), metric=co["metric"], seen=seen)
        watch.add("/collapse", "api_max_mismatch", co.getint("max_mismatch"))
        return watch.on(df, "/collapse", n_thresholded_sequences=_rows(), n_no_group=F.count_if(F.col("brain") == ""), n_remerged=F.count_if(F.col("vbc_read") != F.col("vbc_read_orig")))

    def vbctable(self, watch: Watch) -> DataFrame:
        vt = self.cp["vbctable"]
        df = B.drop_unmatched(self.out["collapsed"])
        least = self.samples.agg(F.max("min_reads")).first()[0]
        before = df
        if least and least > 1:
            df = B.sample_threshold(df, self.samples)
        df = B.site_threshold(df, vt.getint("target_min_reads"), vt.getint("inj_min_reads"))
        files.write_frames({"spikeqc.prethresh": M.spikein_qc(before), "spikeqc.postthresh": M.spikein_qc(df)}, self.folder)
        counts = B.vbc_table(B.merge_samples(df) if vt.getboolean("merge_samples") else df, ("brain", "region", "site", "ourtube"))
        return watch.on(counts, "/vbctable", n_vbcs=_rows())

    def vbcfiltered(self, watch: Watch) -> DataFrame:
        fl = self.cp["vbcfilter"]
        lone = fl.getboolean("include_lone")
        files.write_frames({"controls": B.control_readout(self.out["vbctable"], fl.getint("target_min_umi"), lone)}, self.folder)
        flags = {"require_injection": "require_injection", "include_injection": "include_injection", "include_controls": "include_controls", "use_negative": "use_target_negative", "use_water": "use_target_water_control"}
        df = B.vbc_filter(self.out["vbctable"], fl.getint("inj_min_umi"), fl.getint("target_min_umi"), fl.getint("target_min_umi_absolute"), include_lone=lone, **{k: fl.getboolean(v) for k, v in flags.items()})
        return watch.on(df, "/vbcfilter", n_vbcs=_rows())

    def matrices(self, watch: Watch) -> dict[str, DataFrame]:
        groups = self.samples.select("label", F.when(F.col("siteinfo").startswith("injection"), "injection").otherwise("target").alias("grp")).dropDuplicates(["label"])
        return M.make_matrices(self.out["vbcfiltered"], groups, self.samples)

    # --- making and finding ---

    def _found(self, step: str, digest: str) -> dict | None:
        """The numbers of a stage that was written to its end from the same inputs."""
        text = files.read_text(self.spark, f"{self.folder}/{step}.json")
        note = json.loads(text) if text else {}
        return note.get("stats") if note.get("digest") == digest else None

    def _make(self, step: str) -> dict:
        watch = Watch()
        if step == "matrices":
            rows = files.matrix_rows(self.matrices(watch))
            for b in self._brains():
                mine = lambda kind: F.count_if((F.col("brain") == b) & (F.col("kind") == kind))  # noqa: B023, E731
                rows = watch.on(rows, f"/matrices/brain_{b}", n_vbcs_real=mine("rbcm"), n_vbcs_spike=mine("sbcm"))
            files.write_matrices(rows, f"{self.folder}/matrices")
        else:
            files.write_table(getattr(self, step)(watch), f"{self.folder}/{step}")
        self.made.append(step)
        return watch.tree()

    def go(self, halt: str | None = None, force: tuple[str, ...] = ()) -> dict[str, DataFrame]:
        """Make or find the stages up to ``halt``; those in ``force`` are made whatever is found."""
        digest = ""
        for step in STEPS:
            digest = self.digest(step, digest)
            note = None if step in force else self._found(step, digest)
            if note is None:
                note = self._make(step)
                files.write_text(self.spark, f"{self.folder}/{step}.json", json.dumps({"digest": digest, "stats": note}))
            self.stats = files.merge_stats([self.stats, note])
            if step == "matrices":
                self.out |= {f"matrices_{k}": v for k, v in self.matrices(Watch()).items()}
            else:
                self.out[step] = self.spark.read.parquet(f"{self.folder}/{step}.parquet")
            if step == halt:
                break
        files.write_text(self.spark, f"{self.folder}/stats.json", json.dumps(self.stats, indent=2, sort_keys=True))
        return self.out


def run(spark: SparkSession, cp: configparser.ConfigParser, pairs: list[tuple[str, str]], samples: DataFrame, barcodes: DataFrame, folder: str, halt: str | None = None, force: bool | tuple[str, ...] = False) -> dict[str, DataFrame]:
    """Stage tables by name, and under ``folder`` as ``<stage>.parquet``.

    A stage found there is not made again if it was written to its end from the same
    inputs and settings; ``force`` makes all stages, or those named, anew.  Rejected
    reads, controls and matrices are TSV beside them, and ``stats.json`` has the numbers
    of all stages.  ``halt`` names the last stage wanted.  The folder is one that the
    whole cluster shares.
    """
    if halt and halt not in STEPS:
        raise ValueError(f"no stage {halt}; stages are {', '.join(STEPS)}")
    return Run(spark, cp, pairs, samples, barcodes, folder).go(halt, STEPS if force is True else tuple(force or ()))
