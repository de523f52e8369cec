"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app: str = "strata", cores: int | str = "*", **conf) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        # Directories are listed by tasks; by default every directory is a task of its own.
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "32")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send the package to the workers, once per application.

    Tasks name the helpers they run by module, and a worker need not start where the driver did.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="strata-package-")).resolve() / "strata.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the checkpoint folder the session names.

    Executors and later runs must see what is written there, so on a cluster the
    setting has to be present. Only a local master may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="strata-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/strata/{label}-{uuid.uuid4().hex[:12]}"
