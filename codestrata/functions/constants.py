"""Fixed values.  These define the result, so they must not drift: the file
extensions, directory names, labels, sizes and patterns below are part of the
record definition, not tuning knobs."""

# version stamped on every record
SCHEMA_VERSION = "1.0.0"

# extension -> language
EXTENSION_LANGUAGES = {
    ".py": "python",
    ".js": "javascript",
    ".ts": "typescript",
    ".jsx": "javascript",
    ".tsx": "typescript",
    ".java": "java",
    ".go": "go",
    ".rs": "rust",
    ".rb": "ruby",
    ".cs": "csharp",
    ".cpp": "cpp",
    ".c": "c",
    ".h": "c",
    ".swift": "swift",
    ".kt": "kotlin",
    ".md": "markdown",
    ".json": "json",
    ".yaml": "yaml",
    ".yml": "yaml",
    ".toml": "toml",
    ".sh": "shell",
    ".bash": "shell",
}

# extensions of files that are collected
SOURCE_EXTENSIONS = [
    ".py", ".js", ".ts", ".jsx", ".tsx", ".java", ".go", ".rs", ".rb", ".cs",
    ".cpp", ".c", ".h", ".swift", ".kt",
]

# a directory with one of these names hides everything below it
SKIPPED_DIRECTORIES = [
    "node_modules", ".git", "dist", "build", "__pycache__", "vendor", "coverage",
    "test", "tests", "__tests__", "spec", "fixtures", ".cache", "tmp",
]

TEST_DIRECTORIES = ["test", "tests", "__tests__", "spec"]

ENTRY_POINT_STEMS = ["index", "main", "app", "server"]

# manifest file name -> ecosystem
MANIFEST_TYPES = {
    "package.json": "npm",
    "requirements.txt": "pip",
    "Pipfile": "pip",
    "pyproject.toml": "pip",
    "pom.xml": "maven",
    "build.gradle": "gradle",
    "Cargo.toml": "cargo",
    "go.mod": "go",
    "Gemfile": "bundler",
    "composer.json": "composer",
}

README_NAMES = [
    "README.md", "README.rst", "README.txt", "README", "readme.md", "readme.rst",
]

# languages in which a file without imports is nothing to warn about
DATA_LANGUAGES = ["json", "yaml", "toml", "markdown", "shell"]

MAX_FILE_BYTES = 102400
MIN_FILE_BYTES = 10
HISTORY_DAYS = 90
RECENT_DAYS = 30
LOG_COMMITS_PER_FILE = 50
TOP_CONTRIBUTORS = 3
TOP_FILES = 5

# fields that have no value when a file has no commits
COMMIT_FIELDS = [
    "most_recent_commit_sha",
    "most_recent_commit_timestamp",
    "most_recent_commit_author",
    "most_recent_commit_message",
    "days_since_last_change",
    "top_contributors",
]

# suffixes probed, in this order, after the exact path of a path-like import
PATH_SUFFIXES = [
    ".js", ".ts", ".jsx", ".tsx", "/index.js", "/index.ts", "/index.jsx", "/index.tsx",
]

# suffixes probed, in this order, for a dotted module name
MODULE_SUFFIXES = [".py", "/__init__.py"]

# an import text holding one of these is computed at run time
DYNAMIC_MARKS = ["+", "${", "`"]
