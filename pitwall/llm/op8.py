"""Query of operator 8: judge every url of ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitwall.llm import urls
from pitwall.llm.common import table

#: The rules of the contract.
RULES = [urls.Rule("net", "/", "block"), urls.Rule("example.net", "/en/", "allow"),
         urls.Rule("example.com", "/de/", "block"), urls.Rule("org", "/fr/", "allow")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return urls.judge(table(spark, sf_dir, "pages"), RULES)


QUERIES = {"op8_url_filter": op8_url_filter}
#: Components are iterative; tests compare with a brute-force version.
ORACLE: dict[str, str] = {}
