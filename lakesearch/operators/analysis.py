"""Rule-based analysis of question texts: projections only, one pass, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakesearch.functions.text import contains_any, count_tokens, let, sorted_set

# Query classes in order of preference, each with its patterns.
CLASS_PATTERNS = {
    "conceptual": [r"\b(what is|describe|explain|overview|about|understand|concept)\b",
                   r"\b(purpose|goal|meaning|definition)\b"],
    "functional": [r"\b(how does|how to|mechanism|process|work|function|operate)\b",
                   r"\b(algorithm|logic|flow|procedure)\b"],
    "example": [r"\b(example|sample|demo|show me|usage|demonstrate)\b",
                r"\b(how to use|implement|apply|tutorial)\b"],
    "comparison": [r"\b(compare|difference|vs|versus|better|alternative)\b",
                   r"\b(option|choice|between|against)\b"],
    "debugging": [r"\b(error|bug|issue|problem|fix|debug|troubleshoot)\b",
                  r"\b(not working|broken|fails|wrong)\b"],
    "implementation": [r"\b(create|build|implement|add|develop|make)\b",
                       r"\b(new feature|functionality|construct)\b"],
    "file_search": [r"\b(find file|locate file|where is|file location)\b",
                    r"\b(\.py|\.js|\.html|\.css|\.md|\.json)\b",
                    r"\b(file|folder|directory|path)\b"],
    "code_search": [r"\b(find function|find class|find method|locate code)\b",
                    r"\b(function|class|method|variable|constant)\b"],
}

# Patterns of entities (whole match) and of specific targets (group 1).
# One capital run stands for CamelCase: the nested form matches the same words but
# backtracks without bound.
ENTITY_PATTERNS = [
    r"\b[A-Z][a-zA-Z]*\b",
    r"\b[a-z_][a-z0-9_]*\(\)\b",
    r"\b[a-z_][a-z0-9_]*\b",
    r"\b[A-Z_][A-Z0-9_]*\b",
    r"[a-zA-Z_][a-zA-Z0-9_]*\.[a-zA-Z_][a-zA-Z0-9_]*",
    r"[a-zA-Z0-9_/.-]+\.[a-z]{2,4}",
    r"/[a-zA-Z0-9_/.-]+",
]
TARGET_PATTERNS = [
    r"""["']([^"']+)["']""",
    r"\b([a-zA-Z0-9_-]+\.[a-zA-Z]{2,4})\b",
    r"\bfunction\s+([a-zA-Z_][a-zA-Z0-9_]*)",
    r"\bdef\s+([a-zA-Z_][a-zA-Z0-9_]*)",
    r"\b([a-zA-Z_][a-zA-Z0-9_]*)\s*\(\)",
    r"\bclass\s+([A-Z][a-zA-Z0-9_]*)",
    r"\b([A-Z][a-zA-Z]*)\b",
]

# Word lists.
STOP_WORDS = ["the", "and", "or", "but", "how", "what", "why", "where", "when",
              "this", "that", "with", "for", "from", "can", "you", "me", "it"]
INTENT_TERMS = [
    "function", "class", "method", "variable", "import", "module",
    "api", "endpoint", "database", "query", "response", "request",
    "test", "debug", "error", "exception", "config", "setup",
    "component", "service", "model", "view", "controller",
    "authentication", "authorization", "validation", "form",
    "frontend", "backend", "client", "server", "middleware",
]
FIND_WORDS = ["find", "locate", "where"]
FIND_EXTENSIONS = [".py", ".js", ".html", ".css", ".md"]
WIDE_WORDS = ["architecture", "system", "project", "repository"]
MODULE_WORDS = ["module", "package", "component"]
UNIT_WORDS = ["function", "method", "class"]

DIRECT, CONTEXTUAL, SEMANTIC, FILES = (
    "direct_entity_search", "contextual_search", "semantic_repository_search", "file_structure_search")


def query_type(query: Column) -> Column:
    """The class with the most pattern matches; ties go to the earlier class."""
    text = F.lower(query)
    names = F.array(*[F.lit(name) for name in CLASS_PATTERNS])
    scores = F.array(*[sum((F.regexp_count(text, F.lit(p)) for p in patterns), F.lit(0))
                       for patterns in CLASS_PATTERNS.values()])
    best = let(scores, lambda s: F.when(
        F.array_max(s) > 0, F.element_at(names, F.array_position(s, F.array_max(s)).cast("int"))))
    unscored = (F.when(contains_any(text, FIND_WORDS),
                       F.when(contains_any(text, FIND_EXTENSIONS), "file_search").otherwise("code_search"))
                .otherwise("conceptual"))
    return F.coalesce(best, unscored)


def entities(query: Column) -> Column:
    found = F.flatten(F.array(*[F.regexp_extract_all(query, F.lit(p), F.lit(0)) for p in ENTITY_PATTERNS]))
    kept = F.filter(found, lambda e: (F.length(e) > 2) & ~F.lower(e).isin(STOP_WORDS))
    return sorted_set(F.transform(kept, lambda e: F.btrim(e, F.lit("()"))))


def specific_targets(query: Column) -> Column:
    return sorted_set(F.flatten(F.array(
        *[F.regexp_extract_all(query, F.lit(p), F.lit(1)) for p in TARGET_PATTERNS])))


def scope(query: Column, found: Column) -> Column:
    text = F.lower(query)
    return (F.when(contains_any(text, WIDE_WORDS), "cross-cutting")
            .when(contains_any(text, MODULE_WORDS), "module")
            .when((F.size(found) == 1) & contains_any(text, UNIT_WORDS), "file")
            .when(F.size(found) > 3, "cross-cutting").otherwise("module"))


def complexity(query: Column, found: Column) -> Column:
    words, n = count_tokens(query), F.size(found)
    return (F.when((words <= 5) & (n <= 1), "simple")
            .when((words > 15) | (n > 4), "complex").otherwise("medium"))


def intent_keywords(query: Column) -> Column:
    text = F.lower(query)
    return F.filter(F.array(*[F.lit(t) for t in INTENT_TERMS]), lambda term: F.contains(text, term))


def search_strategies(kind: Column, found: Column, targets: Column) -> Column:
    """Ordered strategy names; a name may repeat."""
    def some(condition: Column, name: str) -> Column:
        return F.when(condition, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))

    return F.concat(
        some(kind == "file_search", FILES), some(F.size(targets) > 0, DIRECT), F.array(F.lit(SEMANTIC)),
        some(kind == "code_search", DIRECT),
        some(kind.isin("functional", "implementation", "example", "debugging"), CONTEXTUAL),
        some(F.size(found) > 1, CONTEXTUAL))


ANALYSIS_COLUMNS = ["query_type", "entities", "specific_targets", "scope", "complexity",
                    "intent_keywords", "search_strategies", "confidence", "repository_context"]


def analyze_query(questions: DataFrame) -> DataFrame:
    """Add the analysis columns to (query_id, query[, repository_context], ...).

    A null or empty query gets the fixed low-confidence default.
    """
    query, blank = F.col("query"), F.coalesce(F.col("query"), F.lit("")) == ""
    none = F.array().cast("array<string>")
    context = (F.coalesce(F.col("repository_context"), F.lit(""))
               if "repository_context" in questions.columns else F.lit(""))
    parsed = {
        "query_type": F.when(blank, "conceptual").otherwise(query_type(query)),
        "entities": F.when(blank, none).otherwise(entities(query)),
        "specific_targets": F.when(blank, none).otherwise(specific_targets(query)),
        "intent_keywords": F.when(blank, none).otherwise(intent_keywords(query)),
        "confidence": F.when(blank, 0.1).otherwise(0.9),
        "repository_context": context}
    # The generator keeps Catalyst from merging the two projections, which would match
    # every pattern again for each later use of the entities.
    once = F.inline(F.array(F.struct(*[c.alias(name) for name, c in parsed.items()])))
    others = [c for c in questions.columns if c != "repository_context"]
    return (questions.select(*others, once)
            .withColumns({
                "scope": F.when(blank, "file").otherwise(scope(query, F.col("entities"))),
                "complexity": F.when(blank, "simple").otherwise(complexity(query, F.col("entities"))),
                "search_strategies": F.when(blank, F.array(F.lit(SEMANTIC))).otherwise(
                    search_strategies(F.col("query_type"), F.col("entities"), F.col("specific_targets")))}))
