"""Settings of a run: an INI file over defaults, and its snapshot."""

from __future__ import annotations

import configparser

#: The default settings of a run.
DEFAULTS = {
    "project": {"project_id": "M000"},
    "fastq": {"r1start": "0", "r1end": "32", "r2start": "0", "r2end": "20", "max_repeats": "7", "max_n_bases": "0", "min_reads": "2", "source_regex": "(.+?)_", "filter_by_non_dominant": "False", "filter_column": "ssi", "filter_by_sampleinfo_ssi": "False", "ourtube_regex": ".+?-(.+?)_"},
    "split": {"vbc_read_st": "0", "vbc_read_end": "30", "spikeseq_st": "24", "spikeseq_end": "32", "libtag_st": "30", "libtag_end": "32", "umi_st": "32", "umi_end": "44", "ssi_st": "44", "ssi_end": "52"},
    "readtable": {"spikeseq": "CGTCAGTC", "realregex": "[TC][TC]$", "loneregex": "[AG][AG]$", "use_libtag": "True", "use_lone": "True", "filter_by_libtag": "True"},
    "collapse": {"max_mismatch": "3", "min_reads": "2", "metric": "hamming"},
    "vbctable": {"inj_min_reads": "2", "target_min_reads": "2", "merge_samples": "False"},
    "vbcfilter": {"require_injection": "True", "include_injection": "True", "include_controls": "True", "include_lone": "False", "use_target_negative": "False", "use_target_water_control": "False", "inj_min_umi": "10", "target_min_umi": "2", "target_min_umi_absolute": "1"},
}


def settings(path: str | None = None, **more: dict[str, str]) -> configparser.ConfigParser:
    """The defaults, then the file's values, then the sections given; a file that can't be read is an error."""
    cp = configparser.ConfigParser(interpolation=None)
    cp.read_dict(DEFAULTS)
    if path:
        with open(path) as f:
            cp.read_file(f)
    cp.read_dict(more)
    return cp


def write_settings(cp: configparser.ConfigParser, path: str) -> None:
    with open(path, "w") as f:
        cp.write(f)
