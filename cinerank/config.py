"""Settings shared by every job: constants, thresholds and storage locations.

No hosts or connector endpoints live in code; tables are addressed through a
root path plus a format, so a document store or search index is a matter of
``format``/``options`` in :class:`TableStore`.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# --- Fixed values that must equal the reference's for the same results. ---
# Genre keywords of the per-genre top list, in the reference's order.
DEFAULT_GENRES = (
    "Action", "Adventure", "Animation", "Comedy", "Crime", "Documentary",
    "Drama", "Family", "Fantasy", "Foreign", "History", "Horror", "Music",
    "Mystery", "Romance", "Science", "Tv", "Thriller", "War", "Western",
)
# Marker that precedes a rating message inside a raw log line.
RATING_MARKER = "MOVIE_RATING_PREFIX:"
# Constant key of every republished rating message.
REPUBLISH_KEY = "logProcessor"
# Field separators of the three text inputs and of the rating message.
MOVIE_SEP = "^"
RATING_SEP = ","
TAG_SEP = ","
MESSAGE_SEP = "|"
# Bounds and thresholds.
RECENT_RATINGS_K = 20        # recent ratings considered per event
CANDIDATES_K = 20            # candidate items per event
USER_RECS_K = 20             # recommendations per user
GENRE_TOP_K = 10             # items per genre
SIM_LIST_THRESHOLD = 0.6     # stored latent-factor similarity list, strict >
SIM_SCORE_THRESHOLD = 0.7    # similarity used in real-time scoring, strict >
TF_BUCKETS = 50              # hashed term-frequency buckets
POSITIVE_RATING = 3.0        # rating > 3 strengthens, <= 3 weakens
MICRO_BATCH = "2 seconds"    # processing-time trigger of the streaming job
# --- end of fixed values ---

SCORE_DIGITS = 6   # scores are rounded before ranking so ties are stable
FIXED_DIGITS = 12  # thresholds compare scores at so many decimals: all but binary noise


@dataclass(frozen=True)
class TableStore:
    """Where named tables live and how they are written/read."""

    root: str
    format: str = "parquet"
    options: dict = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def _context(spark: SparkSession):
    """The SparkContext, or None where the session has none (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 -- Connect sessions raise here
        return None


def parallelism(spark: SparkSession) -> int:
    """Task slots to plan for: the cluster's default parallelism, else the
    session's shuffle partition count."""
    sc = _context(spark)
    if sc is not None:
        return int(sc.defaultParallelism)
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Read from the session (``spark.checkpoint.dir``).  Only when the setting
    is absent on a local master -- tests -- a private folder is created and
    registered; on a cluster its absence is an error, since executors could
    not see a folder of the driver's.
    """
    sc = _context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "") if sc is None else sc.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="cinerank-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def materialize(df, kind: str = "materialized"):
    """Compute ``df`` once and cut its lineage by writing it as a Parquet
    table under the shared checkpoint folder and reading it back.  Survives
    executor loss (unlike a local checkpoint) and gives the optimizer real
    file sizes for its join choices."""
    spark = df.sparkSession
    path = scratch_dir(spark, kind)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_dir(spark: SparkSession, kind: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/cinerank/{kind}-{uuid.uuid4().hex}"
