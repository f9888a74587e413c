"""Session settings that every plan of this package assumes."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(master: str | None = None, name: str = "leafmill", **settings: str) -> SparkSession:
    """A session in UTC with ANSI mode and adaptive execution; settings given here win over the defaults."""
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": os.environ.get("LEAFMILL_UI", "false"),
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): v for k, v in settings.items()}
    builder = SparkSession.builder.appName(name).config(map=conf)
    return (builder.master(master) if master else builder).getOrCreate()
