"""SQL scripts: statements split at semicolons outside quotes and comments, run in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def split_statements(script: str) -> list[str]:
    """The script's statements without comments; blank ones are left out."""
    out, now, i, n = [], [], 0, len(script)
    while i < n:
        c, two = script[i], script[i : i + 2]
        if c in "'\"`":
            j = i + 1
            while j < n and script[j] != c:
                j += 2 if script[j] == "\\" and c != "`" else 1
            now.append(script[i : j + 1])
            i = j + 1
        elif two == "--" or c == "#":
            j = script.find("\n", i)
            i = n if j < 0 else j
        elif two == "/*" and script[i : i + 3] != "/*+":
            j = script.find("*/", i + 2)
            now.append(" ")
            i = n if j < 0 else j + 2
        elif c == ";":
            out.append("".join(now).strip())
            now, i = [], i + 1
        else:
            now.append(c)
            i += 1
    out.append("".join(now).strip())
    return [s for s in out if s]


def run_script(spark: SparkSession, script: str) -> list[DataFrame]:
    """Run each statement; an error stops the script and is raised."""
    return [spark.sql(s) for s in split_statements(script)]


def run_script_file(spark: SparkSession, path: str) -> list[DataFrame]:
    """Run a script from any store that Spark reads."""
    return run_script(spark, spark.read.option("wholetext", True).text(path).first()[0])
