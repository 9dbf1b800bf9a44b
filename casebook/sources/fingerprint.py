"""What a product is made from, as a short text that changes when any of it does."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame

#: Columns and lists of a plan are cut off beyond this setting.
_FIELDS = "spark.sql.debug.maxToStringFields"


def fingerprint(df: DataFrame, *arguments: object) -> str | None:
    """A hash of a frame's plan, of the names, sizes and times of the files it reads, and of arguments.

    It is the same in another session, and changes with the code that makes the frame. None if the frame
    also reads what has no files and no literal rows, as what comes from Python lists: such a product cannot
    be known again. The files' names pass through the driver, as in Spark's own listing.
    """
    spark = df.sparkSession
    plan = df._jdf.queryExecution().analyzed()
    marks = hashlib.sha256(repr(arguments).encode())
    before = spark.conf.get(_FIELDS)
    spark.conf.set(_FIELDS, str(1 << 20))
    try:
        text = plan.canonicalized().toString()
        leaves = plan.collectLeaves().iterator()
        while leaves.hasNext():
            leaf = leaves.next()
            kind = leaf.getClass().getSimpleName()
            if kind == "LocalRelation":
                marks.update(leaf.data().toString().encode())
            elif kind == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
                for name in sorted(_files(leaf.relation().location())):
                    marks.update(name.encode())
            elif kind not in ("Range", "OneRowRelation"):
                return None
    finally:
        spark.conf.set(_FIELDS, before)
    # Variables of functions on arrays are numbered anew each time.
    marks.update(re.sub(r"\b(\w+?)_\d+#\d+", r"\1", text).encode())
    return marks.hexdigest()


def _files(location) -> list[str]:
    """Name, size and time of each file of a relation."""
    out, found = [], location.allFiles().iterator()
    while found.hasNext():
        file = found.next()
        out.append(f"{file.getPath()} {file.getLen()} {file.getModificationTime()}")
    return out
