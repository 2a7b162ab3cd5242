"""Static imports as column expressions.

``raw_imports`` runs the regular expressions once per row and only those of the row's own
language.  ``classify`` works on that short array, so internal/external and
the own-package rule never touch the file content again."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from codestrata.functions.text import empty_strings, extract_all, starts_with_any

# The import forms of each language; <w> and <s> are the word and space classes.
# JS_STATIC and GO_BLOCK say what is found; JS_STATIC_SCAN and GO_BLOCK_SCAN find it in one pass.
PYTHON_IMPORT = r"^import[<s>]+([<w>.]+)"
PYTHON_FROM = r"^from[<s>]+([.<w>]+)[<s>]+import"
JS_STATIC = (
    r"""(?:import|export)[<s>]+(?:(?:[<w><s>{},*]+|['"][^'"]+['"])[<s>]+from[<s>]+)?['"]([^'"]+)['"]"""
)
JS_REQUIRE = r"""require[<s>]*\([<s>]*['"]([^'"]+)['"][<s>]*\)"""
JS_DYNAMIC = r"""import[<s>]*\([<s>]*['"]([^'"]+)['"][<s>]*\)"""
JAVA_IMPORT = r"^import[<s>]+([<w>.]+)[<s>]*;"
GO_SINGLE = r"""^import[<s>]+"([^"]+)\""""
GO_BLOCK = r"import[<s>]*\(([^)]+)\)"
GO_PATH = r'"([^"]+)"'
GO_BLOCK_SCAN = r"import[<s>]*\((?:([^)]++)\)|[^)]*+)"
JS_STATIC_SCAN = (
    r"""(?:import|export)(?=[<s>])(?:(?:[<s>][<w><s>{},*]+[<s>]from[<s>]+"""
    r"""|(?:[<w><s>{},*]*(?:import|export))?[<s>]+(?:['"][^'"]++['"][<s>]+from[<s>]+)?)"""
    r"""['"]([^'"]++)['"]|[<w><s>{},*]*+)"""
)
RUST_USE = r"^use[<s>]+([<w>:]+)"
RUST_MOD = r"^(?:pub[<s>]+)?mod[<s>]+([<w>]+)[<s>]*;"
RUBY_REQUIRE = r"""require(?:_relative)?[<s>]+['"]([^'"]+)['"]"""

LANGUAGES = ["python", "javascript", "typescript", "java", "go", "rust", "ruby"]
RUST_OWN = ["crate::", "self::", "super::"]


def _prefixed(prefix: str, items: Column, suffix: str = "") -> Column:
    return F.transform(items, lambda x: F.concat(F.lit(prefix), x, F.lit(suffix)))


def raw_python(content: Column) -> Column:
    return F.concat(
        _prefixed("import ", extract_all(content, PYTHON_IMPORT)),
        _prefixed("from ", extract_all(content, PYTHON_FROM), " import ..."),
    )


def _found(content: Column, scan: str) -> Column:
    """What a scan found.  It also matches, with an empty group, the stretches it has done with."""
    return F.filter(extract_all(content, scan), lambda x: x != "")


def raw_js(content: Column) -> Column:
    """``JS_STATIC`` looks from every keyword for the next character that is no name, space or bracket.  All
    keywords before that character look for the same one, so the scan takes the whole stretch
    from its first keyword on: an import if it ends in ``from`` or a keyword and a quoted text follows, and else
    nothing.  Either way the search goes on behind it."""
    return F.array_distinct(
        F.concat(
            _found(content, JS_STATIC_SCAN),
            extract_all(content, JS_REQUIRE),
            extract_all(content, JS_DYNAMIC),
        )
    )


def raw_java(content: Column) -> Column:
    return _prefixed("import ", extract_all(content, JAVA_IMPORT))


def raw_go(content: Column) -> Column:
    blocks = F.transform(_found(content, GO_BLOCK_SCAN), lambda b: extract_all(b, GO_PATH))
    return F.array_distinct(F.concat(extract_all(content, GO_SINGLE), F.flatten(blocks)))


def raw_rust(content: Column) -> Column:
    return F.concat(
        _prefixed("use ", extract_all(content, RUST_USE)),
        _prefixed("mod ", extract_all(content, RUST_MOD)),
    )


def raw_ruby(content: Column) -> Column:
    return extract_all(content, RUBY_REQUIRE)


def raw_imports(content: Column, language: Column) -> Column:
    """Import texts of one file, in the order they are reported."""
    return (
        F.when(language == "python", raw_python(content))
        .when(language.isin("javascript", "typescript"), raw_js(content))
        .when(language == "java", raw_java(content))
        .when(language == "go", raw_go(content))
        .when(language == "rust", raw_rust(content))
        .when(language == "ruby", raw_ruby(content))
        .otherwise(empty_strings())
    )


def _module(raw: Column, language: Column) -> Column:
    """The name inside a raw text: ``from a.b import ...`` -> ``a.b``, ``mod m`` -> ``crate::m``."""
    spaced = F.split_part(raw, F.lit(" "), F.lit(2))
    return (
        F.when(language.isin("python", "java"), spaced)
        .when((language == "rust") & raw.startswith("mod "), F.concat(F.lit("crate::"), spaced))
        .when(language == "rust", spaced)
        .otherwise(raw)
    )


def _is_internal(raw: Column, language: Column, package: Column | None) -> Column:
    own = F.lit(False)
    if package is not None:
        own = F.coalesce(_module(raw, language).startswith(F.concat(package, F.lit("."))), F.lit(False))
    return (
        F.when(language == "python", raw.startswith("from .") | own)
        .when(language.isin("javascript", "typescript"), starts_with_any(raw, ["./", "../", "/"]))
        .when(
            language == "rust",
            raw.startswith("mod ") | starts_with_any(raw, ["use " + p for p in RUST_OWN]),
        )
        .when(language == "ruby", starts_with_any(raw, ["./", "../"]))
        .otherwise(F.lit(False))
    )


def classify(raw: Column, language: Column, package: Column | None = None) -> Column:
    """``struct<internal, external>``.  ``package`` is the repository's own top-level Python
    package; without it, absolute imports of the own package count as external."""
    pick = lambda keep: F.transform(
        F.filter(raw, keep), lambda r: _module(r, language)
    )
    return F.struct(
        pick(lambda r: _is_internal(r, language, package)).alias("internal"),
        pick(lambda r: ~_is_internal(r, language, package)).alias("external"),
    )


def warnings(content_length: Column, language: Column) -> Column:
    message = F.concat(F.lit("import extraction not supported for language: "), language)
    return F.when(
        (content_length > 0) & ~language.isin(LANGUAGES), F.array(message)
    ).otherwise(empty_strings())


def import_struct(raw: Column, content_length: Column, language: Column, package: Column | None = None) -> Column:
    """The whole extraction result of one file."""
    parts = classify(raw, language, package)
    return F.struct(
        raw.alias("raw"),
        parts["internal"].alias("internal"),
        parts["external"].alias("external"),
        empty_strings().alias("unresolved"),
        warnings(content_length, language).alias("warnings"),
    )
