"""Column expressions over repository-relative, slash-separated paths."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from codestrata.functions import constants as C


def _label_map(labels: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dirname(path: Column) -> Column:
    """Everything before the last slash; empty for a root file."""
    return F.regexp_extract(path, r"(?s)\A(.*)/", 1)


def extension(path: Column) -> Column:
    """Lower-cased last extension.  Leading dots belong to the name: ``.bashrc`` has none."""
    return F.lower(_raw_extension(path))


def _raw_extension(path: Column) -> Column:
    name = F.regexp_replace(basename(path), r"^[.]+", "")
    return F.regexp_extract(name, r"[.][^.]*\z", 0)


def stem(path: Column) -> Column:
    name = basename(path)
    return F.lower(F.left(name, F.length(name) - F.length(_raw_extension(path))))


def depth(path: Column) -> Column:
    return F.size(F.split(path, "/")) - 1


def directories(path: Column) -> Column:
    """Directory components, without the file name."""
    parts = F.split(path, "/")
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def language(path: Column) -> Column:
    return F.coalesce(
        F.try_element_at(_label_map(C.EXTENSION_LANGUAGES), extension(path)), F.lit("unknown")
    )


def manifest_type(path: Column) -> Column:
    return F.try_element_at(_label_map(C.MANIFEST_TYPES), basename(path))


def is_readme(path: Column) -> Column:
    return basename(path).isin(C.README_NAMES)


def skipped_directory(path: Column) -> Column:
    """First directory component that hides the file, or null."""
    return F.get(F.filter(directories(path), lambda d: d.isin(C.SKIPPED_DIRECTORIES)), 0)


def skip_reason(path: Column, size: Column) -> Column:
    """Why a tree entry is not collected; null for a source file."""
    hidden = skipped_directory(path)
    return (
        F.when(~extension(path).isin(C.SOURCE_EXTENSIONS), F.lit("non_source_extension"))
        .when(hidden.isNotNull(), F.concat(F.lit("path_component:"), hidden))
        .when(F.coalesce(size, F.lit(0)) > C.MAX_FILE_BYTES, F.lit("too_large"))
    )


def is_collectable(path: Column) -> Column:
    """The path part of :func:`skip_reason`, without the size."""
    hidden = F.exists(directories(path), lambda d: d.isin(C.SKIPPED_DIRECTORIES))
    return extension(path).isin(C.SOURCE_EXTENSIONS) & ~hidden


def is_entry_point(path: Column) -> Column:
    return stem(path).isin(C.ENTRY_POINT_STEMS) & (depth(path) <= 1)


def is_in_test_directory(path: Column) -> Column:
    return F.exists(directories(path), lambda d: d.isin(C.TEST_DIRECTORIES))


def test_directory(path: Column) -> Column:
    """Prefix, with a closing slash, up to the first test-named directory, or null."""
    flags = F.transform(directories(path), lambda d: d.isin(C.TEST_DIRECTORIES))
    position = F.array_position(flags, True).cast("int")
    prefix = F.array_join(F.slice(F.split(path, "/"), F.lit(1), position), "/")
    return F.when(position > 0, F.concat(prefix, F.lit("/")))


def ancestor_prefixes(path: Column) -> Column:
    """``a/b/c.py`` -> ``[a/, a/b/]``; empty for a root file."""
    names = directories(path)
    return F.transform(
        names,
        lambda _, i: F.concat(F.array_join(F.slice(names, F.lit(1), i + 1), "/"), F.lit("/")),
    )


def path_hash(path: Column) -> Column:
    return F.substring(F.sha2(path, 256), 1, 12)


def artifact_name(path: Column) -> Column:
    """Label only: different paths can share it, so it is never used as a key."""
    flat = F.replace(F.replace(path, F.lit("/"), F.lit("__")), F.lit("."), F.lit("_"))
    return F.concat(flat, F.lit(".json"))


def run_name(repo_id: Column, branch: Column, commit_sha: Column) -> Column:
    return F.concat_ws(
        "__", F.replace(repo_id, F.lit("/"), F.lit("__")), branch, F.substring(commit_sha, 1, 7)
    )


def normalize(path: Column) -> Column:
    """Collapse ``.``, ``..`` and empty components of a relative path; ``.`` if nothing is left."""

    def step(kept: Column, part: Column) -> Column:
        nothing_to_leave = (F.size(kept) == 0) | (F.try_element_at(kept, F.lit(-1)) == "..")
        return (
            F.when(part.isin("", "."), kept)
            .when((part != "..") | nothing_to_leave, F.concat(kept, F.array(part)))
            .otherwise(F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
        )

    folded = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step)
    joined = F.array_join(folded, "/")
    return F.when(joined == "", F.lit(".")).otherwise(joined)


def import_base(file_path: Column, import_text: Column) -> Column:
    """Path an import text points at, before any suffix is tried."""
    directory = dirname(file_path)
    joined = F.when(directory == "", import_text).otherwise(
        F.concat(directory, F.lit("/"), import_text)
    )
    slashes = lambda c: F.replace(c, F.lit("\\"), F.lit("/"))
    return (
        F.when(import_text.startswith("./") | import_text.startswith("../"), slashes(normalize(joined)))
        .when(import_text.startswith("/"), slashes(F.ltrim(import_text, F.lit("/"))))
        .otherwise(F.replace(import_text, F.lit("."), F.lit("/")))
    )


def is_path_import(import_text: Column) -> Column:
    return (
        import_text.startswith("./") | import_text.startswith("../") | import_text.startswith("/")
    )
