"""Table schemas.  Readers never infer."""

from pyspark.sql import types as T

#: identity of one snapshot of one repository
KEY = ["repo_id", "commit_sha"]
#: identity of one file in one snapshot
FILE = ["repo_id", "commit_sha", "path"]

TEXT = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
FLAG = T.BooleanType()
TIME = T.TimestampType()
TEXTS = T.ArrayType(TEXT)
COUNTS = T.MapType(TEXT, LONG)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


SNAPSHOTS = struct(repo_id=TEXT, branch=TEXT, commit_sha=TEXT, committed_at=TIME)
TREE = struct(repo_id=TEXT, commit_sha=TEXT, path=TEXT, sha=TEXT, size=LONG)
CONTENTS = struct(repo_id=TEXT, commit_sha=TEXT, path=TEXT, content=TEXT, blob_sha=TEXT)
COMMITS = struct(
    repo_id=TEXT, commit_sha=TEXT, path=TEXT, sha=TEXT, author_name=TEXT, message=TEXT,
    timestamp_raw=TEXT, committed_at=TIME, ordinal=LONG,
)

# landed API responses, one JSON document per line
TREE_RESPONSE = struct(
    repo_id=TEXT, commit_sha=TEXT, truncated=FLAG,
    tree=T.ArrayType(struct(path=TEXT, type=TEXT, sha=TEXT, size=LONG)),
)
CONTENT_RESPONSE = struct(repo_id=TEXT, commit_sha=TEXT, path=TEXT, sha=TEXT, content=TEXT)
COMMIT_PAGE = struct(
    repo_id=TEXT, commit_sha=TEXT, path=TEXT, page=LONG,
    commits=T.ArrayType(
        struct(sha=TEXT, commit=struct(message=TEXT, author=struct(name=TEXT, date=TEXT)))
    ),
)
COMMIT_LOG = struct(repo_id=TEXT, commit_sha=TEXT, path=TEXT, log=TEXT)
COMMIT_TRIGGER = struct(repo_id=TEXT, branch=TEXT, commit_sha=TEXT, parent_sha=TEXT, committed_at=TIME)

#: the file record
FILE_RECORD = struct(
    repo_id=TEXT, commit_sha=TEXT, file_path=TEXT, blob_sha=TEXT, file_path_hash=TEXT,
    schema_version=TEXT, fetched_at=TIME,
    language=TEXT, raw_content=TEXT, line_count=INT, char_count=INT, size_bytes=LONG,
    imports_raw=TEXTS, imports_internal=TEXTS, imports_external=TEXTS, imports_unresolved=TEXTS,
    dependents=TEXTS,
    most_recent_commit_sha=TEXT, most_recent_commit_timestamp=TIME, most_recent_commit_author=TEXT,
    most_recent_commit_message=TEXT, commit_frequency_30d=LONG, commit_frequency_90d=LONG,
    days_since_last_change=INT, top_contributors=TEXTS,
    is_entry_point_candidate=FLAG, is_in_test_directory=FLAG, relative_depth=INT,
    determined_by=TEXTS, parse_warnings=TEXTS, could_not_determine=TEXTS,
)

#: the repository record
REPO_RECORD = struct(
    repo_id=TEXT, commit_sha=TEXT, branch=TEXT, fetched_at=TIME, schema_version=TEXT,
    total_file_count=LONG, source_file_count=LONG, language_distribution=COUNTS,
    directory_structure=COUNTS, max_directory_depth=INT,
    has_readme=FLAG, readme_length_chars=INT, readme_headers=TEXTS, has_package_manifest=FLAG,
    manifest_type=TEXT, has_test_directory=FLAG, test_directories=TEXTS, entry_point_candidates=TEXTS,
    most_active_files=TEXTS, largest_files=TEXTS, commit_frequency_30d=LONG,
    files_collected=LONG, files_skipped=LONG, skip_reasons=COUNTS, collection_errors=TEXTS,
    determined_by=TEXTS,
)

#: lists that are longer than a record holds, in parts
PARTS = struct(
    repo_id=TEXT, commit_sha=TEXT, path=TEXT, kind=TEXT, part=INT, first=TEXT, last=TEXT, n=LONG,
    items=T.ArrayType(struct(value=TEXT, n=LONG)),
)
