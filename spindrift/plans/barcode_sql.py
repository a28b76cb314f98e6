"""The barcode read table derived from ``lineitem`` by SQL that Spark and DuckDB both read.

Only integer columns, md5 and plain string functions are used, so both engines
give the same rows: 30-base barcodes with planted substitutions, 12-base
molecule ids, samples BC0..BC15 on sites of two subjects and one without.
"""

READTABLE = """
SELECT CASE WHEN type = 'spike' THEN concat(head, 'CGTCAG') ELSE concat(head, substr(h, 25, 6)) END AS vbc_read,
  umi, type, read_count, concat('BC', CAST(n AS STRING)) AS label,
  CASE WHEN n % 8 = 0 THEN 'injection' WHEN n % 8 = 6 THEN 'target-negative' WHEN n % 8 = 7 THEN 'target-water-control' ELSE 'target' END AS site,
  CASE WHEN n % 8 = 7 THEN '' WHEN n < 8 THEN 'b1' ELSE 'b2' END AS brain, src AS source
FROM (SELECT *, CASE WHEN ln % 4 = 3 THEN concat(substr(h, 1, p - 1), translate(substr(h, p, 1), 'ACGT', 'CATG'), substr(h, p + 1, 24 - p)) ELSE substr(h, 1, 24) END AS head
  FROM (SELECT *, CASE WHEN ls = 'F' AND pk % 10 = 0 THEN 'spike' WHEN rf = 'R' AND pk % 7 = 0 THEN 'lone' ELSE 'real' END AS type, CAST(sk % 20 AS INT) + 1 AS p
    FROM (SELECT l_partkey AS pk, l_suppkey AS sk, l_linenumber AS ln, l_returnflag AS rf, l_linestatus AS ls, CAST(l_quantity AS BIGINT) AS read_count,
        translate(md5(concat('v', CAST(l_partkey AS STRING))), '0123456789abcdef', 'ACGTACGTACGTACGT') AS h,
        substr(translate(md5(concat('u', CAST(l_suppkey AS STRING), '-', CAST(l_orderkey % 50 AS STRING))), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 12) AS umi,
        CAST(l_suppkey % 16 AS INT) AS n, concat('run', CAST(l_orderkey % 3 AS STRING)) AS src
      FROM lineitem) AS base) AS typed) AS headed
"""

#: Raw 52-base reads: barcode, tag, molecule id and sample barcode at fixed places; some carry an N or a long run.
READ_COLUMNS = """concat(CASE WHEN read_count % 11 = 0 THEN concat('N', substr(vbc_read, 2)) WHEN read_count % 13 = 0 THEN concat('AAAAAAAA', substr(vbc_read, 9)) ELSE vbc_read END,
  CASE WHEN type = 'spike' THEN 'TC' WHEN type = 'lone' THEN 'AG' ELSE 'CT' END, umi,
  substr(translate(md5(label), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 8)) AS sequence, source, read_count, type, label"""
READS = f"SELECT {READ_COLUMNS} FROM ({READTABLE}) AS rt"
