"""The table of model runs: log, rank, promote, retire."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

RUNS = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("version", T.IntegerType()),
    T.StructField("algorithm", T.StringType()),
    T.StructField("stage", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("cutoff", T.DoubleType()),
    T.StructField("roc_auc", T.DoubleType()),
    T.StructField("f1", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("cv_scores", T.ArrayType(T.DoubleType())),
    T.StructField("val_score", T.DoubleType()),
    T.StructField("test_score", T.DoubleType()),
    T.StructField("search_end", T.StringType()),
    T.StructField("origin", T.StringType()),
])

DEVELOPMENT, STAGING, PRODUCTION = "development", "staging", "production"


def mean_cv(scores: str = "cv_scores"):
    """Mean of an array of fold scores."""
    total = F.aggregate(scores, F.lit(0.0), lambda acc, x: acc + x)
    return F.try_divide(total, F.size(scores))


def new_runs(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Records of finished fits; `val_score` is the mean of `cv_scores`."""
    filled = [{f.name: row.get(f.name) for f in RUNS} for row in rows]
    return spark.createDataFrame(filled, RUNS).withColumn("val_score", mean_cv())


LOG = "_log"
#: Times that a change is worked out anew when another writer was faster.
RETRIES = 20


class Conflict(Exception):
    """Another writer has put the commit that this one was to be."""


def _hadoop(spark: SparkSession, path: str):
    """The path, its file system, and the context whose rename refuses a target that is there."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    return root, fs, jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(root).toUri(), conf)


def commits(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the commits in the log of the table at `path`, in order."""
    _, fs, _ = _hadoop(spark, path)
    log = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{LOG}")
    names = [s.getPath().getName() for s in fs.listStatus(log)] if fs.exists(log) else []
    return sorted(int(n[:20]) for n in names if len(n) == 25 and n[:20].isdigit() and n.endswith(".json"))


def last_snapshot(spark: SparkSession, path: str) -> int:
    """Number of the newest commit, 0 if there is none."""
    return max(commits(spark, path), default=0)


def _commit_file(path: str, number: int) -> str:
    return f"{path}/{LOG}/{number:020d}.json"


def data_of(spark: SparkSession, path: str, number: int) -> str:
    """The folder that a commit names."""
    text = spark.sparkContext.wholeTextFiles(_commit_file(path, number), 1).values().first()
    return f"{path}/{json.loads(text)['data']}"


def put_commit(spark: SparkSession, path: str, number: int, data: str) -> None:
    """Put commit `number`, which makes the folder `data` the table, unless it is there.

    The file is written aside and moved into place whole; the move is refused if the place is taken, so of two
    writers one gets a `Conflict`. A writer that dies before leaves files that nothing names.
    """
    jvm = spark._jvm
    _, fs, context = _hadoop(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(f"{path}/{LOG}/.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps({"number": number, "data": data}).encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        context.rename(aside, jvm.org.apache.hadoop.fs.Path(_commit_file(path, number)), options)
    except Py4JJavaError as error:
        fs.delete(aside, False)
        if "FileAlreadyExistsException" in str(error.java_exception.toString()):
            raise Conflict(f"commit {number} of {path} is there already") from None
        raise


def load_runs(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table as of commit `number`, or of the newest. What another writer commits meanwhile changes nothing."""
    number = last_snapshot(spark, path) if number is None else number
    if number == 0:
        raise FileNotFoundError(f"no runs at {path}")
    return spark.read.schema(RUNS).parquet(data_of(spark, path, number))


def change_runs(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Commit what `change` makes of the newest table (an empty one at first), and return the table committed.

    Data is written to a folder of its own first, then the commit that follows the one read is put. If another
    writer was faster, the change is worked out anew from that writer's table, so no change is lost.
    """
    for _ in range(RETRIES):
        number = last_snapshot(spark, path)
        old = load_runs(spark, path, number) if number else spark.createDataFrame([], RUNS)
        data = f"data-{uuid.uuid4().hex}"
        change(old).select(*RUNS.names).write.mode("error").parquet(f"{path}/{data}")
        try:
            put_commit(spark, path, number + 1, data)
        except Conflict:
            continue
        return load_runs(spark, path, number + 1)
    raise Conflict(f"{path} changed {RETRIES} times meanwhile")


def save_runs(runs: DataFrame, path: str) -> None:
    """Make `runs` the whole table, whatever it was."""
    change_runs(runs.sparkSession, path, lambda old: runs)


def vacuum_runs(spark: SparkSession, path: str, keep: int = 10, older_than_hours: float = 24.0) -> int:
    """Remove data folders that none of the last `keep` commits names; younger ones may be a writer's at work."""
    root, fs, _ = _hadoop(spark, path)
    held = {data_of(spark, path, n).rsplit("/", 1)[1] for n in commits(spark, path)[-keep:]}
    before = 1000 * (time.time() - 3600 * older_than_hours)
    gone = [s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("data-")
            and s.getPath().getName() not in held and s.getModificationTime() <= before]
    for folder in gone:
        fs.delete(folder, True)
    return len(gone)


def last_versions(spark: SparkSession, path: str) -> dict[str, int]:
    """The highest version of each run in the table, for versions to be given out before models are saved."""
    if last_snapshot(spark, path) == 0:
        return {}
    rows = load_runs(spark, path).groupBy("run_id").agg(F.max("version").alias("last")).collect()
    return {r["run_id"]: r["last"] for r in rows}


def log_runs(runs: DataFrame, path: str) -> None:
    """Add records. A record without version gets the next one of its run."""
    def add(old: DataFrame) -> DataFrame:
        known = old.groupBy("run_id").agg(F.max("version").alias("last"))
        given = runs.join(known, "run_id", "left").withColumn(
            "version", F.coalesce(F.col("version"), F.col("last") + 1, F.lit(1)))
        taken = given.where(F.col("version") <= F.col("last")).select("run_id").first()
        if taken is not None:
            raise ValueError(f"run {taken['run_id']} has this or a later version already")
        return old.unionByName(given.select(*RUNS.names))

    change_runs(runs.sparkSession, path, add)


def current(runs: DataFrame) -> DataFrame:
    """The newest version of each run."""
    whole = F.max_by(F.struct(*[c for c in runs.columns if c != "run_id"]), "version")
    return runs.groupBy("run_id").agg(whole.alias("run")).select("run_id", "run.*")


def query_runs(runs: DataFrame, metric: str, **tags: str | list[str]) -> DataFrame:
    """Runs with the given tags, best first."""
    for tag, value in tags.items():
        runs = runs.where(F.col(tag).isin(value if isinstance(value, list) else [value]))
    return runs.orderBy(F.desc(metric), "run_id")


def top_per_algorithm(runs: DataFrame, candidates: int, algorithms: list[str]) -> DataFrame:
    """The best floor(candidates / algorithms) runs of each algorithm by validation score.

    Spark keeps only that many rows of a group in each task before the shuffle.
    """
    n = candidates // len(algorithms)
    order = Window.partitionBy("algorithm").orderBy(F.desc("val_score"), "run_id")
    return (
        runs.where(F.col("algorithm").isin(algorithms))
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= n)
    )


def candidates(runs: DataFrame, n: int) -> DataFrame:
    """The n best runs by validation score, numbered by test score. A table of at most n rows."""
    best = runs.orderBy(F.desc("val_score"), "run_id").limit(n)
    return best.withColumn(
        "place", F.row_number().over(Window.orderBy(F.desc("test_score"), "run_id"))
    )


def champion(runs: DataFrame) -> DataFrame:
    """The production run, the best by test score if there are several, as one row or none."""
    held = runs.where(F.col("stage") == PRODUCTION)
    return held.orderBy(F.desc("test_score"), "run_id").limit(1)


def assign_stages(runs: DataFrame, n: int, update_champion: bool = True) -> DataFrame:
    """`runs`, a row for each run and version, with stages set anew.

    A row without a stage is retired and stays so. Of the others all but the champion fall back to
    development, the n best by validation score go to staging, and the best of those by test score takes the
    champion's place if it is strictly better (or the place is free). A version of a run competes with the
    others like any run: a staged version stays until it is beaten. One scan; the table of runs is small
    enough for its ranks to be taken in one task.
    """
    def order(score: str) -> list:
        return [F.desc(score), F.col("run_id"), F.col("version")]

    by_test = Window.partitionBy("stage").orderBy(*order("test_score"))
    ranked = runs.withColumn("crowned", (F.col("stage") == PRODUCTION) & (F.row_number().over(by_test) == 1))
    pool = F.col("stage").isNotNull() & ~F.col("crowned")
    ranked = ranked.withColumn("pool", F.coalesce(pool, F.lit(False)))
    by_validation = Window.partitionBy("pool").orderBy(*order("val_score"))
    ranked = ranked.withColumn("challenger", F.col("pool") & (F.row_number().over(by_validation) <= n))
    first = Window.partitionBy("challenger").orderBy(*order("test_score"))
    whole = Window.partitionBy()
    ranked = ranked.withColumns({
        "best": F.col("challenger") & (F.row_number().over(first) == 1),
        "crowns": F.max(F.col("crowned").cast("int")).over(whole),
        "bar": F.max(F.when(F.col("crowned"), F.col("test_score"))).over(whole),
    })
    free = F.coalesce(F.col("crowns"), F.lit(0)) == 0
    beats = F.coalesce(F.col("test_score") > F.col("bar"), F.col("bar").isNull() & F.col("test_score").isNotNull())
    wins = F.col("best") & (free | beats if update_champion else free)
    ranked = ranked.withColumn("wins", F.coalesce(wins, F.lit(False)))
    ranked = ranked.withColumn("beaten", F.max("wins").over(whole))
    stage = (
        F.when(F.col("stage").isNull(), F.lit(None).cast("string"))
        .when(F.col("wins"), PRODUCTION)
        .when(F.col("crowned"), F.when(F.col("beaten"), STAGING).otherwise(PRODUCTION))
        .when(F.col("challenger"), STAGING)
        .otherwise(DEVELOPMENT)
    )
    return ranked.withColumn("stage", stage).select(*runs.columns)


def hold_best(runs: DataFrame, candidates: int, algorithms: list[str]) -> DataFrame:
    """Rows in development or staging keep their stage if they are among their algorithm's best.

    Of each algorithm floor(candidates / algorithms) rows are held, by validation score. The champion is none
    of them and keeps its stage.
    """
    n = candidates // len(algorithms)
    pool = F.coalesce(F.col("stage").isin(DEVELOPMENT, STAGING), F.lit(False))
    order = Window.partitionBy("pool", "algorithm").orderBy(F.desc("val_score"), "run_id", "version")
    held = runs.withColumn("pool", pool).withColumn("place", F.row_number().over(order))
    stage = F.when(F.col("pool") & (F.col("place") > n), F.lit(None)).otherwise(F.col("stage"))
    return held.withColumn("stage", stage).select(*runs.columns)


def retain(runs: DataFrame) -> DataFrame:
    """Rows that hold a stage; the others are left out of the next snapshot."""
    return runs.where(F.col("stage").isNotNull())


def promoted(runs: DataFrame, candidates: int, algorithms: list[str], update_champion: bool = True) -> DataFrame:
    """The next table of runs: the best of each algorithm held, stages set anew, all others dropped."""
    return retain(assign_stages(hold_best(runs, candidates, algorithms), candidates, update_champion))


def stage_order() -> list:
    """Production first, then staging by test score, then development by validation score."""
    rank = F.when(F.col("stage") == PRODUCTION, 0).when(F.col("stage") == STAGING, 1).otherwise(2)
    score = F.when(F.col("stage") == DEVELOPMENT, F.col("val_score")).otherwise(F.col("test_score"))
    return [rank, score.desc(), F.col("run_id")]


BOARD = ["roc_auc", "f1", "precision", "recall", "accuracy"]


def leaderboard(runs: DataFrame) -> DataFrame:
    """Staged runs with metrics in percent and their distance to the mean of all staged runs."""
    held = runs.where(F.col("stage").isin(PRODUCTION, STAGING, DEVELOPMENT))
    board = held.withColumns({f"{m}_pct": 100.0 * F.bround(m, 3) for m in BOARD})
    means = board.agg(*[F.avg(f"{m}_pct").alias(m) for m in BOARD])
    gaps = {
        f"{m}_gap": F.bround(F.bround(100.0 * F.col(m), 2) - means.select(m).scalar(), 2) for m in BOARD
    }
    return board.withColumns(gaps).orderBy(*stage_order()).select(
        "run_id", "stage", "algorithm", *[f"{m}_pct" for m in BOARD], *gaps
    )
