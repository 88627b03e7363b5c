"""Timetable and reference files derived from the tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackside.sources.tables import read_table
from trackside.testfeed.frames import attr
from trackside.testfeed.messages import association_element, q, schedule_element

ROOT = "PportTimetable"
REFERENCE_ROOT = "PportTimetableRef"


def _inside_root(rows: DataFrame, root: str) -> DataFrame:
    """Each file's texts between the tags of a root element."""

    def wrap(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": [f'<?xml version="1.0" encoding="UTF-8"?>\n<{root}>']})
        yield from batches
        yield pd.DataFrame({"value": [f"</{root}>"]})

    return rows.mapInPandas(wrap, "value string")


def write_timetable(orders: DataFrame, path: str) -> None:
    """Files of journeys, and files of associations, in one folder."""
    plat = attr("plat", "cast(1 + o_orderkey % 9 as string)")
    journey = schedule_element("Journey", "", plat, (attr("qtrain", q("true"), "o_orderkey % 31 = 0"),))
    for element in (journey, association_element("Association", "")):
        texts = orders.select(F.expr(element).alias("value"))
        _inside_root(texts, ROOT).write.mode("append").option("compression", "none").text(path)


# Which table a reference list is made of, and its columns (attribute -> SQL).
LISTS = {
    "LocationRef": (
        "part",
        {
            "tpl": "concat('P', cast(p_partkey as string))",
            "crs": "case when p_partkey % 3 = 0 then concat('S', lpad(cast(p_partkey % 100 as string), 2, '0')) end",
            "toc": "case when p_partkey % 2 = 0 then concat('O', cast(p_partkey % 10 as string)) end",
            "locname": "p_name",
        },
    ),
    "TocRef": (
        "nation",
        {
            "toc": "lpad(cast(n_nationkey as string), 2, '0')",
            "tocname": "n_name",
            "url": "case when n_nationkey % 2 = 0 then concat('http://x/', cast(n_nationkey as string), '?a=1&b=2') end",
        },
    ),
    "Via": (
        "supplier",
        {
            "at": "concat('S', lpad(cast(s_suppkey % 100 as string), 2, '0'))",
            "dest": "concat('P', cast(s_nationkey as string))",
            "loc1": "concat('P', cast(s_suppkey % 7 as string))",
            "loc2": "case when s_suppkey % 2 = 0 then concat('P', cast(s_suppkey % 11 as string)) end",
            "viatext": "concat('via ', s_name)",
        },
    ),
    "CISSource": ("region", {"code": "concat('CI0', cast(r_regionkey as string))", "name": "r_name"}),
}


def write_reference(spark: SparkSession, sf: str, path: str) -> None:
    """Reference files, one list each, in one folder."""
    for tag, (table, columns) in LISTS.items():
        rows = read_table(spark, sf, table).selectExpr(*[f"{sql} as _{name}" for name, sql in columns.items()])
        _write(rows, tag, path)
    nation = read_table(spark, sf, "nation")
    for tag, text in (("LateRunningReasons", "late"), ("CancellationReasons", "cancelled")):
        # The list of nations is fixed and short.
        reasons = nation.agg(
            F.collect_list(
                F.struct((F.col("n_nationkey") + 100).alias("_code"), F.concat(F.lit(f"{text} "), "n_name").alias("_reasontext"))
            ).alias("Reason")
        )
        _write(reasons, tag, path)


def _write(rows: DataFrame, tag: str, path: str) -> None:
    (
        rows.write.mode("append")
        .format("xml")
        .option("rootTag", REFERENCE_ROOT)
        .option("rowTag", tag)
        .save(path)
    )


REFERENCE_SQL = """
SELECT 'location' AS list, concat('P', CAST(p_partkey AS VARCHAR)) AS code, concat_ws('/',
    CASE WHEN p_partkey % 3 = 0 THEN concat('S', lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0')) END,
    CASE WHEN p_partkey % 2 = 0 THEN concat('O', CAST(p_partkey % 10 AS VARCHAR)) END, p_name) AS text FROM part
UNION ALL SELECT 'operator', lpad(CAST(n_nationkey AS VARCHAR), 2, '0'), concat_ws('/', n_name,
    CASE WHEN n_nationkey % 2 = 0 THEN concat('http://x/', CAST(n_nationkey AS VARCHAR), '?a=1&b=2') END) FROM nation
UNION ALL SELECT 'late', CAST(n_nationkey + 100 AS VARCHAR), concat('late ', n_name) FROM nation
UNION ALL SELECT 'cancel', CAST(n_nationkey + 100 AS VARCHAR), concat('cancelled ', n_name) FROM nation
UNION ALL SELECT 'via', concat('S', lpad(CAST(s_suppkey % 100 AS VARCHAR), 2, '0')), concat_ws('/',
    concat('P', CAST(s_nationkey AS VARCHAR)), concat('P', CAST(s_suppkey % 7 AS VARCHAR)),
    CASE WHEN s_suppkey % 2 = 0 THEN concat('P', CAST(s_suppkey % 11 AS VARCHAR)) END, concat('via ', s_name)) FROM supplier
UNION ALL SELECT 'instance', concat('CI0', CAST(r_regionkey AS VARCHAR)), r_name FROM region
"""
