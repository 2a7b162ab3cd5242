"""Sources and commit tables.  Landed texts are put together from the given tables and parsed
back; tests do the same through files."""

import hashlib
import uuid

from pyspark.sql import functions as F

from codestrata import schemas as S
from codestrata.catalog import fixtures as X
from codestrata.catalog.registry import query
from codestrata.functions.times import instant
from codestrata.functions.text import git_blob_sha
from codestrata.operators import history as H
from codestrata.operators import selection as L
from codestrata.plans.parse import with_content_metrics
from codestrata.session import materialize, workspace
from codestrata.sources import landing as D
from codestrata.sources.artifacts import load_run


@query("SELECT repo_id, path, sha, CASE WHEN lang = 'de' THEN 0 ELSE size END AS size, lang = 'fr' AS truncated FROM files")
def src_tree_api_json(spark, sf):
    rows = X.tree(spark, sf, "lang")
    known = F.when(F.col("lang") != "de", F.col("size"))  # a null size is left out of the JSON
    blob = F.struct("path", F.lit("blob").alias("type"), "sha", known.alias("size"))
    folder = F.struct(
        F.lit("lib").alias("path"), F.lit("tree").alias("type"), "sha", F.lit(None).cast("bigint").alias("size")
    )
    landed = rows.select(
        F.to_json(
            F.struct(
                "repo_id", "commit_sha", (F.col("lang") == "fr").alias("truncated"),
                F.array(folder, blob).alias("tree"),
            )
        ).alias("json")
    )
    responses = landed.select(F.from_json("json", S.TREE_RESPONSE).alias("r")).select("r.*")
    return D.parse_tree_json(responses).drop("commit_sha")


@query("SELECT repo_id, path, sha, CASE WHEN lang = 'de' THEN 0 ELSE size END AS size FROM files")
def src_tree_listing_text(spark, sf):
    rows = X.tree(spark, sf, "lang")
    size = F.when(F.col("lang") == "de", F.lit("-")).otherwise(F.col("size").cast("string"))
    blob = F.format_string("100644 blob %s %7s\t%s", "sha", size, "path")
    lines = F.array(
        blob,
        F.concat(F.lit("040000 tree "), "sha", F.lit("       -\tlib")),
        F.concat(F.lit("100644 blob\t"), "path"),
        F.concat(F.lit("100644 blob "), "sha", F.lit(" 12 "), "path"),
    )
    landed = rows.select("repo_id", "commit_sha", F.explode(lines).alias("value"))
    return D.parse_tree_listing(landed).drop("commit_sha")


@query("SELECT repo_id, path, md5(coalesce(content, '')) AS content_md5, sha AS blob_sha FROM files")
def src_content_api_json(spark, sf):
    rows = X.contents(spark, sf, F.expr(X.TREE_SHA).alias("sha"))
    data = F.coalesce(F.col("content").cast("binary"), F.unhex(F.lit("FFFE")))
    folded = F.regexp_replace(F.base64(data), "(.{60})", "$1\n")
    landed = rows.select(
        F.to_json(F.struct(*S.FILE, "sha", folded.alias("content"))).alias("json")
    )
    responses = landed.select(F.from_json("json", S.CONTENT_RESPONSE).alias("r")).select("r.*")
    return D.parse_content_json(responses).select(
        "repo_id", "path", F.md5("content").alias("content_md5"), "blob_sha"
    )


@query("""SELECT repo_id, path, md5(coalesce(content, '')) AS content_md5,
  CASE WHEN content IS NULL THEN '' ELSE sha1(encode('blob ' || strlen(crlf)) || '\\x00'::BLOB || encode(crlf)) END AS blob_sha
  FROM (SELECT *, CASE WHEN lang = 'fr' THEN replace(content, chr(10), chr(13) || chr(10)) ELSE content END AS crlf FROM files)""")
def src_content_snapshot(spark, sf):
    rows = X.contents(spark, sf, "lang")
    crlf = F.replace("content", F.lit("\n"), F.lit("\r\n"))
    text = F.when(F.col("lang") == "fr", crlf).otherwise(F.col("content"))
    data = F.coalesce(text.cast("binary"), F.unhex(F.lit("FFFE")))
    return D.parse_snapshot_files(rows.select(*S.FILE, data.alias("data"))).select(
        "repo_id", "path", F.md5("content").alias("content_md5"), "blob_sha"
    )


@query("""SELECT repo_id, path, sha, author_name, message, epoch_us(date_trunc('second', ts)) AS committed_micros,
  event_id * 1000000 AS ordinal FROM commits
  UNION ALL SELECT repo_id, path, 'x' || sha, author_name, 'second', epoch_us(date_trunc('second', ts)),
  event_id * 1000000 + 1 FROM commits""")
def src_commits_api_json(spark, sf):
    rows = X.commits(spark, sf, "event_id")
    date = F.date_format("committed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def item(sha, message):
        author = F.struct(F.col("author_name").alias("name"), date.alias("date"))
        commit = F.struct(message.alias("message"), author.alias("author"))
        return F.struct(sha.alias("sha"), commit.alias("commit"))

    first = item(F.col("sha"), F.concat("message", F.lit("\n\nbody")))
    second = item(F.concat(F.lit("x"), "sha"), F.lit("second"))
    landed = rows.select(
        F.to_json(
            F.struct(*S.FILE, F.col("event_id").alias("page"), F.array(first, second).alias("commits"))
        ).alias("json")
    )
    pages = landed.select(F.from_json("json", S.COMMIT_PAGE).alias("r")).select("r.*")
    return D.parse_commit_pages(pages).select(
        "repo_id", "path", "sha", "author_name", "message",
        F.unix_micros("committed_at").alias("committed_micros"), "ordinal",
    )


@query("""SELECT repo_id, path, sha, author_name, message || ' | more' AS message,
  epoch_us(date_trunc('second', ts)) - CASE WHEN lang = 'en' THEN 0 ELSE 7200000000 END AS committed_micros, event_id AS ordinal FROM commits""")
def src_commits_log_text(spark, sf):
    rows = X.commits(spark, sf, "event_id", "lang")
    offset = F.when(F.col("lang") == "en", F.lit(" +0000")).otherwise(F.lit(" +0200"))
    stamp = F.concat(F.date_format("committed_at", "yyyy-MM-dd HH:mm:ss"), offset)
    line = F.concat(
        F.concat_ws("|", "sha", "author_name", stamp, "message"), F.lit(" | more ")
    )
    short = F.concat_ws("|", "sha", "author_name", stamp)
    landed = rows.select(
        *S.FILE, F.col("event_id").alias("ordinal"), F.explode(F.array(line, short)).alias("value")
    )
    return D.parse_commit_log(landed).select(
        "repo_id", "path", "sha", "author_name", "message",
        F.unix_micros("committed_at").alias("committed_micros"), "ordinal",
    )


HORIZON = "FROM commits WHERE ts >= TIMESTAMP '2024-04-10' - INTERVAL 90 DAYS"


@query(f"SELECT repo_id, path, sha {HORIZON}")
def commit_horizon(spark, sf):
    kept = H.commit_horizon(X.commits(spark, sf), instant(X.AS_OF_90))
    return kept.select("repo_id", "path", "sha")


@query(f"""SELECT repo_id, path, sha FROM (SELECT *, row_number() OVER (PARTITION BY repo_id, path ORDER BY ts DESC, sha) AS nth
  {HORIZON}) WHERE nth <= 50""")
def commit_horizon_log(spark, sf):
    kept = H.commit_horizon(X.commits(spark, sf), instant(X.AS_OF_90), newest=50)
    return kept.select("repo_id", "path", "sha")


@query("""SELECT repo_id, event_type AS branch, arg_max(sha, ts) AS commit_sha, epoch_us(max(ts)) AS committed_micros
  FROM commits GROUP BY ALL""")
def snapshot_head(spark, sf):
    rows = X.commits(spark, sf, F.col("event_type").alias("branch")).drop("commit_sha")
    heads = L.snapshot_head(rows.withColumnRenamed("sha", "commit_sha"))
    return heads.select(
        "repo_id", "branch", "commit_sha", F.unix_micros("committed_at").alias("committed_micros")
    )


def two_trees(spark, sf):
    rows = X.tree(spark, sf, "lang")
    edited = F.when(F.col("lang") == "fr", F.sha1("sha")).otherwise(F.col("sha"))
    return rows.where("lang <> 'es'"), rows.where("lang <> 'de'").withColumn("sha", edited)


@query("""SELECT repo_id, path, CASE lang WHEN 'es' THEN 'added' WHEN 'de' THEN 'deleted' ELSE 'modified' END AS change
  FROM files WHERE lang IN ('es', 'de', 'fr')""")
def changed_files(spark, sf):
    """Spanish files are new, German ones gone, French ones edited."""
    parent, head = two_trees(spark, sf)
    return L.changed_files(parent, head, ["repo_id", "path"])


@query("""SELECT repo_id, path, CASE lang WHEN 'es' THEN 'added' WHEN 'de' THEN 'deleted' ELSE 'modified' END AS change
  FROM files WHERE lang IN ('es', 'de', 'fr')""")
def changed_files_by_digest(spark, sf):
    """The same through digests of directories, stored for both trees."""
    on = ["repo_id", "path"]
    trees = two_trees(spark, sf)
    digests = [materialize(L.directory_digests(t, on), "digests") for t in trees]
    return L.changed_files_by_digest(*trees, on, *digests)


URLS = """CASE lang WHEN 'en' THEN 'git@host.example:org/' || source || '.git'
  WHEN 'fr' THEN 'https://host.example/org/' || source
  WHEN 'de' THEN 'https://host.example/org/my.' || source ELSE '' END"""


@query("""SELECT doc_id, CASE WHEN lang IN ('en', 'fr') THEN 'org/' || source ELSE 'dir_' || source END AS repo_id
  FROM documents""")
def repo_id_from_remote(spark, sf):
    docs = X.table(spark, sf, "documents")
    directory = F.concat(F.lit("dir_"), "source")
    return docs.select("doc_id", D.repo_id_from_remote(F.expr(URLS), directory).alias("repo_id"))


@query("SELECT doc_id, CASE WHEN lang = 'de' THEN 'HEAD' ELSE lang END AS branch FROM documents")
def branch_or_head(spark, sf):
    docs = X.table(spark, sf, "documents")
    shown = F.when(F.col("lang") == "de", F.lit("\n")).otherwise(F.concat("lang", F.lit("\n")))
    return docs.select("doc_id", D.branch_or_head(shown).alias("branch"))


@query("SELECT repo_id, commit_sha, path, sha FROM files WHERE repo_id = 'org/src3'")
def load_artifacts(spark, sf):
    """One run by repository and seven characters of its commit, from rows stored by both."""
    folder = f"{workspace(spark)}/codestrata/artifacts-{uuid.uuid4().hex}"
    X.tree(spark, sf).write.partitionBy(*S.KEY).parquet(folder)
    stored = spark.read.schema("path string, sha string, size long, repo_id string, commit_sha string").parquet(folder)
    sha = hashlib.sha1(b"head:org/src3").hexdigest()
    return load_run(stored, "org/src3", sha[:7]).select(
        "repo_id", "commit_sha", "path", "sha"
    )


@query("""SELECT repo_id, path, CASE WHEN content IS NULL THEN NULL
  ELSE sha1(encode('blob ' || strlen(content)) || '\\x00'::BLOB || encode(content)) END AS blob_sha FROM files""",
       name="git_blob_sha")
def blob_sha_query(spark, sf):
    return X.contents(spark, sf).select(
        "repo_id", "path", git_blob_sha(F.col("content")).alias("blob_sha")
    )


@query("""SELECT repo_id, path, coalesce(length(content), 0) AS char_count, coalesce(strlen(content), 0) AS content_bytes,
  CASE WHEN coalesce(content, '') = '' THEN 0 ELSE len(string_split(content, chr(10))) END AS line_count FROM files""")
def content_metrics(spark, sf):
    return with_content_metrics(X.contents(spark, sf)).select(
        "repo_id", "path", "char_count", "content_bytes", "line_count"
    )
