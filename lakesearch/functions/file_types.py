"""Rules that type a file by its path and first line."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lakesearch.functions.text import contains_any, lookup, strip, suffix

# Extension → language of the code splitter.
CODE_LANGUAGES = {
    ".py": "python", ".js": "javascript", ".jsx": "javascript", ".cjs": "javascript", ".mjs": "javascript",
    ".ts": "typescript", ".tsx": "typescript", ".java": "java", ".cpp": "cpp", ".c": "c", ".cs": "c_sharp",
    ".go": "go", ".rb": "ruby", ".php": "php", ".rs": "rust", ".swift": "swift", ".kt": "kotlin",
    ".kts": "kotlin", ".scala": "scala", ".sh": "bash",
}

# Extension → language recorded in the index.
INDEX_LANGUAGES = {
    ".py": "python", ".js": "javascript", ".ts": "typescript", ".java": "java", ".cpp": "cpp", ".c": "c",
    ".go": "go", ".rs": "rust", ".php": "php", ".rb": "ruby", ".scala": "scala", ".html": "html",
    ".css": "css", ".sql": "sql", ".yml": "yaml", ".yaml": "yaml", ".json": "json", ".xml": "xml",
    ".md": "markdown",
}

# Extensions of each non-code chunking route.
TABLE_EXTENSIONS = [".csv", ".tsv"]
MARKDOWN_EXTENSIONS = [".md", ".mdx", ".txt", ".rst", ".adoc"]
JSON_EXTENSIONS = [".json", ".jsonl"]
YAML_EXTENSIONS = [".yaml", ".yml"]


def file_type(path: Column, content: Column) -> Column:
    """Extension without its dot; files with no extension or ``.sh`` by their shebang."""
    ext = suffix(path)
    first = strip(F.substring_index(content, "\n", 1))
    shebang = ext.isin("", ".sh") & first.startswith("#!")
    return (F.when(shebang & first.contains("python"), "python")
            .when(shebang & contains_any(first, ["bash", "sh", "zsh"]), "bash")
            .otherwise(F.substring(ext, 2, 1 << 30)))


def code_language(path: Column) -> Column:
    return lookup(CODE_LANGUAGES, suffix(path), "")


def index_language(path: Column) -> Column:
    return lookup(INDEX_LANGUAGES, suffix(path), "unknown")


def chunk_route(path: Column) -> Column:
    """Which chunker a file goes to: table, code, markdown, json, yaml or sentence."""
    ext = suffix(path)
    return (F.when(ext.isin(TABLE_EXTENSIONS), "table")
            .when(ext.isin(list(CODE_LANGUAGES)), "code")
            .when(ext.isin(MARKDOWN_EXTENSIONS), "markdown")
            .when(ext.isin(JSON_EXTENSIONS), "json")
            .when(ext.isin(YAML_EXTENSIONS), "yaml")
            .otherwise("sentence"))
