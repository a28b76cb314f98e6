"""``python -m spindrift``: run all stages or one from FASTQ files, report a run, or check the wells of a qPCR sheet."""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import SparkSession

from spindrift.operators.qpcr import cycle_report
from spindrift.plans.run import STEPS, run
from spindrift.plans.settings import settings, write_settings
from spindrift.sources import files


def _inputs(p: argparse.ArgumentParser) -> None:
    p.add_argument("-c", "--config", help="settings (INI); defaults without one")
    p.add_argument("-s", "--sampleinfo", required=True, help="sample sheet (TSV)")
    p.add_argument("-b", "--barcodes", required=True, help="sample barcodes: label and sequence")
    p.add_argument("-O", "--outdir", required=True, help="a folder that the whole cluster shares")
    p.add_argument("infiles", nargs="+", help="FASTQ files, read 1 and read 2 in turn")


def main(argv: list[str] | None = None) -> None:
    top = argparse.ArgumentParser(prog="spindrift")
    sub = top.add_subparsers(dest="command", required=True)
    p = sub.add_parser("run", help="FASTQ pairs to matrices")
    _inputs(p)
    p.add_argument("-f", "--force", action="store_true", help="make every stage anew")
    p.add_argument("--halt", choices=STEPS, help="the last stage to make")
    for step in STEPS:
        one = sub.add_parser(step, help=f"the stage {step}, after those before it that are missing or out of date")
        _inputs(one)
        one.add_argument("-f", "--force", action="store_true", help="make this stage anew")
    t = sub.add_parser("report", help="fill a Markdown template with a run's numbers and settings")
    t.add_argument("-O", "--outdir", required=True)
    t.add_argument("-t", "--template", required=True)
    t.add_argument("-o", "--outfile", required=True)
    q = sub.add_parser("qpcr", help="cycle ranges of wells")
    q.add_argument("-c", "--config")
    q.add_argument("-o", "--outfile", required=True)
    q.add_argument("infile", help="amplification sheet (TSV)")
    args = top.parse_args(argv)
    spark = SparkSession.builder.appName("spindrift").getOrCreate()
    cp = settings(getattr(args, "config", None))
    if args.command == "qpcr":
        own = cp["qpcr"] if cp.has_section("qpcr") else {}
        report = cycle_report(files.read_amplification(spark, args.infile), float(own.get("group_span", 3)), column=own.get("column", "rn"), sensitivity=float(own.get("kneed_sensitivity", 2)), low_offset=int(own.get("cycle_low_offset", 1)), high_offset=int(own.get("cycle_high_offset", 0)))
        report.orderBy("group_id", "mean", "well_id").write.mode("overwrite").csv(args.outfile, sep="\t", header=True)
        return
    if args.command == "report":
        stats = json.loads(files.read_text(spark, f"{args.outdir}/stats.json") or "{}")
        conf = files.load_config(f"{args.outdir}/settings.conf")
        with open(args.template) as src, open(args.outfile, "w") as to:
            to.write(files.render_report(src.read(), stats, conf))
        return
    if "://" not in args.outdir:
        os.makedirs(args.outdir, exist_ok=True)
        write_settings(cp, f"{args.outdir}/settings.conf")
    last = args.halt if args.command == "run" else args.command
    force = args.force if args.command == "run" else (last,) if args.force else ()
    run(spark, cp, files.pair_files(args.infiles), files.read_samples(spark, args.sampleinfo), files.read_barcodes(spark, args.barcodes), args.outdir, last, force)


if __name__ == "__main__":
    main()
