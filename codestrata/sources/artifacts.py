"""Records on storage: JSON export, typed read, run lookup, bucketed contents."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codestrata import schemas as S
from codestrata.functions.paths import artifact_name
from codestrata.functions.times import iso_text

def record_json(record: DataFrame, schema) -> DataFrame:
    """One JSON text per record, nulls kept, times as ISO text.  A latest-commit time keeps the
    offset of its source where that text is at hand."""
    names = [f.name for f in schema.fields]
    raw = "most_recent_commit_timestamp_raw"

    def field(name: str) -> Column:
        if record.schema[name].dataType.typeName() != "timestamp":
            return F.col(name)
        kept = name == "most_recent_commit_timestamp" and raw in record.columns
        return iso_text(F.col(name), F.col(raw) if kept else None).alias(name)

    present = [n for n in names if n in record.columns]
    body = F.to_json(F.struct(*[field(n) for n in present]), {"ignoreNullFields": "false"})
    return record.select("*", body.alias("json"))


def _as_text(schema) -> str:
    """The schema with times as strings, as they stand in JSON."""
    return ", ".join(
        f"{f.name} {'string' if f.dataType.typeName() == 'timestamp' else f.dataType.simpleString()}"
        for f in schema.fields
    )


def whole_json(text: Column, schema) -> Column:
    """``text``, or an error if its keys are not exactly the fields of ``schema``."""
    names = sorted(schema.fieldNames())
    keys = F.array_sort(F.json_object_keys(text))
    wrong = F.concat(F.lit("not the keys of the record: "), F.coalesce(F.array_join(keys, " "), F.lit("no object")))
    return F.when(keys == F.array(*map(F.lit, names)), text).otherwise(F.raise_error(wrong).cast("string"))


def parse_record_json(rows: DataFrame, schema, column: str = "json", strict: bool = False) -> DataFrame:
    """JSON texts -> typed records; times re-parsed, null times kept.  ``strict`` refuses a text that lacks
    a field or has another one."""
    text = whole_json(F.col(column), schema) if strict else F.col(column)
    parsed = rows.select(F.from_json(text, _as_text(schema), {"mode": "FAILFAST"}).alias("r"))
    return parsed.select(
        *[
            (
                F.to_timestamp(F.col(f"r.{f.name}")).alias(f.name)
                if f.dataType.typeName() == "timestamp"
                else F.col(f"r.{f.name}").alias(f.name)
            )
            for f in schema.fields
        ]
    )


def write_json_artifacts(records: DataFrame, schema, path: str) -> None:
    """JSON lines, one folder per repository and commit.  Small runs end in one file each, and the
    rows of a large one are split over several tasks."""
    (
        record_json(records, schema)
        .select("repo_id", "commit_sha", "json")
        .hint("rebalance", "repo_id", "commit_sha")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("repo_id", "commit_sha")
        .text(path)
    )


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, repo_id, commit_sha``: the texts of :func:`write_json_artifacts`."""
    return spark.read.schema("value string, repo_id string, commit_sha string").text(path)


def read_json_artifacts(spark: SparkSession, path: str, schema, strict: bool = False) -> DataFrame:
    return parse_record_json(read_json_lines(spark, path), schema, "value", strict)


def load_run(records: DataFrame, repo_id: str, commit_sha: str) -> DataFrame:
    """Records of one run: exact repository, commits that start with the whole text given.  On a table
    partitioned by both, this prunes to the run's folder."""
    return records.where((F.col("repo_id") == repo_id) & F.startswith("commit_sha", F.lit(commit_sha)))


def require_run(records: DataFrame, repo_id: str, commit_sha: str) -> DataFrame:
    """:func:`load_run`, or ``FileNotFoundError`` if there is none and ``ValueError`` if the text
    names more than one commit."""
    run = load_run(records, repo_id, commit_sha)
    found = run.select("commit_sha").distinct().limit(2).collect()
    if not found:
        raise FileNotFoundError(f"no records for {repo_id} @ {commit_sha}")
    if len(found) > 1:
        raise ValueError(f"several commits of {repo_id} start with {commit_sha}")
    return run


def load_collection(
    files: DataFrame, repos: DataFrame, repo_id: str, commit_sha: str
) -> tuple[DataFrame, DataFrame]:
    """Repository record and file records of one run, files in the order of their artifact names."""
    named = load_run(files, repo_id, commit_sha).orderBy(artifact_name(F.col("file_path")))
    return require_run(repos, repo_id, commit_sha), named


def save_contents(contents: DataFrame, table: str, buckets: int) -> None:
    """Contents as a table bucketed by file: joins on the file then leave it in place."""
    contents.write.mode("overwrite").bucketBy(buckets, *S.FILE).sortBy(*S.FILE).saveAsTable(table)
