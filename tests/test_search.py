"""The whole search with a plugged-in model, against the stated steps in plain Python."""

from lakesearch.functions.text import token_counter
from lakesearch.operators import context as A
from lakesearch.operators.chunking import chunk_files
from lakesearch.plans.search import agentic_search, text_embedder


def _load_model():
    # Two features: length, and how often the letter e occurs.
    return lambda texts: [[float(len(t)), 1.0 + t.count("e")] for t in texts]


def _vectors(spark):
    rows = []
    for ns in ("a", "b"):
        for i in range(12):
            rows.append((f"{ns}{i:02d}", ns, f"org/{ns}", f"src/{'main' if i == 3 else 'file'}{i}.{'py' if i % 2 else 'md'}",
                         1, f"text {i} about {'Widget' if i == 5 else 'things'}", 0.1 * i, [], [], [float(i), 3.0]))
    return spark.createDataFrame(rows, "id string, namespace string, repo_name string, file_path string, line_start int, content string, "
                                       "code_complexity double, function_names array<string>, class_names array<string>, embedding array<float>")


def _search(spark, requests):
    vectors = _vectors(spark)
    profiles = spark.createDataFrame([("a", ["data"], [".py"], ["src"])],
                                     "namespace string, keywords array<string>, file_types array<string>, structure_clues array<string>")
    mapping = spark.createDataFrame([("org/a", "a")], "repo_name string, namespace string")
    asked = spark.createDataFrame(requests, "query_id int, query string, repositories array<string>")
    return agentic_search(asked, vectors, profiles, mapping, text_embedder(_load_model, "probe_text"),
                          text_embedder(_load_model, "query")), vectors, asked


def test_search_with_a_model(spark):
    top, vectors, asked = _search(spark, [(1, "class Widget explained", ["org/a"]), (2, "where is main3.py", None),
                                          (3, "", None), (4, "anything", ["org/none"])])
    found = {}
    for r in top.orderBy("query_id", "final_rank").collect():
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == {1, 2}
    # Only namespace a; its file types apply to the dense strategies, not to the direct one.
    assert {r.namespace for r in found[1]} == {"a"}
    assert any(r.id == "a05" and r.strategy == "direct_entity_search" for r in found[1])
    assert all(r.file_path.endswith(".py") for r in found[1] if r.strategy != "direct_entity_search")
    # Both namespaces, equal paths collapse, at most ten.
    assert len(found[2]) <= 10 and len({r.file_path for r in found[2]}) == len(found[2])
    assert any("main3.py" in r.file_path and r.strategy == "direct_entity_search" for r in found[2])
    scores = [r.score for r in found[2]]
    assert scores == sorted(scores, reverse=True)
    assert [r.query_id for r in A.no_match_rows(asked.where("query <> ''"), top).collect()] == [4]
    context = {r.query_id: r.context for r in A.context_markdown(A.attach_content(top, vectors)).collect()}
    assert context[1].startswith(f"**File:** {found[1][0].file_path}\n**Repository:** org/a\n\n```\n")


def test_plugged_in_tokenizer(spark):
    files = spark.createDataFrame([("r", "a.txt", "abc de", 6)], "repo_name string, file_path string, content string, size_bytes bigint")
    rows = chunk_files(files, token_counter(lambda: list)).collect()
    assert [(r.content, r.token_count) for r in rows] == [("abc de", 6)]


def test_questions_of_one_partition_are_analysed_by_many_tasks(spark):
    from lakesearch.plans.search import plan_probes
    asked = spark.createDataFrame([(i, f"where is main{i}.py", None) for i in range(64)],
                                  "query_id int, query string, repositories array<string>").coalesce(1)
    profiles = spark.createDataFrame([], "namespace string, keywords array<string>, file_types array<string>, structure_clues array<string>")
    mapping = spark.createDataFrame([], "repo_name string, namespace string")
    _, targets = plan_probes(asked, _vectors(spark), profiles, mapping, text_embedder(_load_model, "probe_text"))
    assert targets.count() == 128 and len(targets.inputFiles()) > 1


def test_probes_carry_only_what_searches_use(spark):
    from lakesearch.operators.retrieval import PROBE_COLUMNS
    from lakesearch.plans.search import plan_probes
    asked = spark.createDataFrame([(1, "where is main1.py", None)], "query_id int, query string, repositories array<string>")
    profiles = spark.createDataFrame([("a", ["main"], [".py"], ["src"])], "namespace string, keywords array<string>, file_types array<string>, structure_clues array<string>")
    mapping = spark.createDataFrame([], "repo_name string, namespace string")
    probes, targets = plan_probes(asked, _vectors(spark), profiles, mapping, text_embedder(_load_model, "probe_text"))
    assert set(probes.columns) == {*PROBE_COLUMNS, "term", "probe_text", "need", "k", "qvec"}
    assert probes.count() and {"query", "entities", "specific_targets", "intent_keywords"} <= set(targets.columns)


MATCH = ("query_id int, query_type string, namespace string, namespace_ord int, id string, file_path string, line_start int, score double, "
         "rank int, strategy string, strategy_ord int, confidence double, term_pos int")


def test_ranking_deals_matches_once(spark):
    from lakesearch.operators import retrieval as R
    rows = [(q, "code_search", "a", 0, f"v{i}", f"f{i % 15}", 1, i / 100, 1, "semantic_repository_search", 2, 0.7, i) for q in (1, 2, None) for i in range(40)]
    top = R.final_top10(R.boosted_rank(R.dedupe_first_seen(spark.createDataFrame(rows, MATCH))))
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert sorted((r.query_id or 0, r.final_rank, r.id) for r in top.collect()) == [(q, n + 1, f"v{14 - n}") for q in (0, 1, 2) for n in range(10)]


def test_fallback_ranks_only_what_it_adds(spark):
    from lakesearch.operators import retrieval as R
    rows = [(q, "code_search", "a", 0, f"m{i}", f"f{i}", 1, 0.5 - i / 100, 1, "semantic_repository_search", 2, 0.7, i) for q in (1, None) for i in range(8)]
    asked = spark.createDataFrame([(q, "code_search", "a", 0, [1.0, 3.0]) for q in (1, 2, None)],
                                  "query_id int, query_type string, namespace string, namespace_ord int, qvec array<float>")
    ranked = R.boosted_rank(spark.createDataFrame(rows, MATCH))
    best, vectors = R.final_top10(ranked), _vectors(spark)

    def shown(df):
        return sorted(((r.query_id or 0, r.final_rank, r.id, round(r.score, 9)) for r in df.collect()))

    # A null id is searched again beside its matches, and its ten best are of both.
    want = shown(R.final_top10(R.fallback_basic(ranked, vectors, asked)))
    assert [sum(q == x[0] for x in want) for q in (0, 1, 2)] == [10, 8, 5]
    found = R.fallback_basic(best, vectors, asked, R.final_top10)
    assert shown(found) == want


def test_distinct_terms_are_found_once(spark, monkeypatch):
    from lakesearch.operators import retrieval as R
    names, staged = [], R.staged
    monkeypatch.setattr(R, "staged", lambda df, name: names.append(name) or staged(df, name))
    terms = spark.createDataFrame([("a", "direct_entity_search", "Widget")] * 3, "namespace string, strategy string, term string")
    assert [r.id for r in R.match_terms(_vectors(spark), terms).collect()] == ["a05"] and names == ["terms"]


def test_answers_share_the_analysis_of_their_search(spark, tmp_path, monkeypatch):
    from lakesearch.plans import search
    from lakesearch.registry import context, retrieval
    spark.createDataFrame([(i, f"part {i}", "kind") for i in range(40)], "p_partkey long, p_name string, p_type string") \
        .write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(i, [1.0, float(i)], i % 5) for i in range(30)], "vec_id long, embedding array<float>, label int") \
        .write.parquet(str(tmp_path / "embeddings.parquet"))
    calls, analyze = [], search.analyze_query
    for owner in (search, retrieval):
        monkeypatch.setattr(owner, "analyze_query", lambda df: calls.append(1) or analyze(df))
    for query in (context.answer_footer, context.attach_answers):
        calls.clear()
        assert query(spark, str(tmp_path)).count() == 36 and len(calls) == 1
