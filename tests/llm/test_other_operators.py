"""HTML, chat, quality, nearest neighbours, the pipeline and the registry."""

import html
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparloom.llm import chat, html_extract, nearest, quality, queries


def test_pages_of_table(spark, sf):
    for r in html_extract.op3_html_extract(spark, sf).join(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = re.search("<article>(.*?)(</article>|$)", r.html, re.S)[1]
        text = " ".join(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", inner))).split())
        assert r.text == text and r.n_chars == len(text)


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain words only", "plain words only"), ("<nav>a b c</nav>", ""),
    ("<p>a<p>b<script>if (a<b) {}</script>", "a b"),
    ('<body><header><a>home</a></header><main><h1>Top</h1><p>one <b>t</b>wo &eacute;&amp;amp;</p></main><footer>f</footer>', "Top one two é&amp;"),
    ('<article><p>first words here</p><div class="ad-slot">buy now</div><p>last words here</p></article>', "first words here last words here"),
    ('<div id="sidebar"><p>aside words</p></div><div class="content"><p>the  real\n text of it</p></div><div class="comments"><p>I say no to that</p></div>', "the real text of it"),
    ('<div class="cookie-notice">we use cookies</div><article class="post nav-open"><p>kept words</p>', "kept words"),
    ("<article><p>cut off in the mid", "cut off in the mid"),
    ('<body><div class="masthead">The Daily Planet</div><div class="x1"><h1>A title</h1><p>It was so and so, and then it went on.</p><p class="promo-code-guide">Use the code at the till and see what comes of it in the end.</p></div><div class="colophon">Set in Garamond by the press</div></body>',
     "A title It was so and so, and then it went on. Use the code at the till and see what comes of it in the end."),
    ('<body><div class="masthead">The Daily Planet</div><article><h1>A title</h1><p>It was so and so, and then it went on.</p><p class="promo-code-guide">Use the code at the till and see what comes of it in the end.</p></article><div class="colophon">Set in Garamond by the press</div></body>',
     "A title It was so and so, and then it went on. Use the code at the till and see what comes of it in the end."),
])
def test_pages(page, text):
    assert html_extract.extract(page) == text


def test_scan_alone_chooses_the_region(spark):
    """Nothing left out of the region: the run itself is the article on the table's pages."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    right = 0
    for r in rows:
        inner = re.search("<article>(.*?)(</article>|$)", r.html, re.S)[1]
        right += html_extract.extract(r.html, whole=True) == " ".join(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", inner))).split())
    assert right >= 0.98 * len(rows)


def test_held_out_layouts():
    """Pages of other seeds than the weights were fitted on."""
    from sparloom.llm.page_layouts import labelled_pages

    right = many = 0
    for page in labelled_pages(200, seed=77):
        plain = re.sub(r"</?(?:a|b|i|em|span|code)\b[^>]*>", "", re.sub(r"<(style|title)\b.*?</\1>", "", page))
        right += html_extract.extract(page.replace("{{", "").replace("}}", "")) == " ".join(re.findall(r"{{(.*?)}}", plain))
        many += 1
    assert right > 0.8 * many


def test_best_run_is_the_greatest_sum():
    rng = np.random.default_rng(0)
    for _ in range(300):
        scores = rng.integers(-5, 5, rng.integers(0, 25)).astype(float).tolist()
        a, b = html_extract.best_run(scores)
        assert sum(scores[a:b]) == max([0.0, *(sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1))])


def test_long_and_deep_pages():
    many = 30_000
    words = " ".join(f"w{k}" for k in range(40))
    assert html_extract.extract("<article>" + f"<p>{words}.</p>" * many + "</article>").count("w0") == many
    assert html_extract.extract("<article><p>a b c.</p>" + "<div>" * many + "</i>" * many).startswith("a b c.")


def test_pages_keep_columns_and_rows(spark):
    rows = spark.createDataFrame([(1, "<p>a b</p>", "t"), (1, "<p>a b</p>", "t"), (None, None, None)], "page_id long, html string, text string")
    out = html_extract.extract_pages(rows)
    assert out.columns == ["page_id", "html", "text", "text_"] and sorted(r.text_ for r in out.collect()) == ["", "a b", "a b"]
    assert html_extract.extract_pages(rows.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_duckdb(spark, sf, name):
    from compare import differences

    assert not differences(spark, sf, queries.QUERIES[name], queries.ORACLE_SQL[name])


def test_chat_round_trip(spark):
    kind = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "u]\nser\\", "a\\b</s\\"), (1, 1, "assistant", "</s></s>\\i[INST[/INST<"), (1, 2, None, None), (None, None, "assistant", "x"), (2, 0, "user", "no reply"), (3, 0, "assistant", "a"), (3, 0, "assistant", "a"), (3, 1, "assistant", "</s>\n[INST user]\n")]
    made = chat.format_conversations(spark.createDataFrame(rows, kind).withColumn("whole", F.lit(1)))
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat.parsed(made).collect()}
    assert back == {1: [(a or "", b or "") for _, _, a, b in rows[:3]], None: [("assistant", "x")], 2: [("user", "no reply")], 3: [("assistant", "a")] * 2 + [("assistant", "</s>\n[INST user]\n")]}
    for e in chat.examples(made).collect():
        assert e.text[e.target_start :] == e.text[e.target_start : e.target_end] and e.text[: e.target_start].endswith("[INST assistant]\n")
    assert chat.examples(made).count() == 5
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], kind))).count() == 0


def test_loss_is_read_by_the_mask(spark, sf):
    """Offsets that say another thing give other digests; the turns stay."""
    made = chat.format_conversations(spark.read.parquet(f"{sf}/conversations.parquet")).cache()
    shift = lambda by: made.withColumn("examples", F.transform("examples", lambda e: F.struct(e["turn"].alias("turn"), (e["target_start"] + by).alias("target_start"), e["target_end"].alias("target_end"))))
    right, none, wrong = ({r.conv_id: r for r in chat.read_back(x).collect()} for x in (made, shift(0), shift(1)))
    assert right == none and len(wrong) == len(right)
    spoken = [k for k, r in right.items() if r.loss_chars]
    assert spoken and all(wrong[k].loss_sha256 != right[k].loss_sha256 and wrong[k].turns_sha256 == right[k].turns_sha256 for k in spoken)
    assert chat.expanded(made).where("turn is not null").count() == spark.read.parquet(f"{sf}/conversations.parquet").where("role = 'assistant'").count()


def test_chat_of_long_texts_and_clashing_columns(spark):
    kind = "conv_id long, turn long, role string, text string"
    text = "[/INST] </s> \\ é" * 20_000
    rows = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text), (1, 2, "assistant", None)], kind)
    rows = rows.withColumns({x: F.lit(1) for x in ("formatted", "examples", "turns", "e", "target", "number", "at")})
    back = chat.read_back(chat.format_conversations(rows)).collect()
    assert [(r.n_turns, r.loss_chars, r.loss_sha256) for r in back] == [(3, len(text), __import__("hashlib").sha256(text.encode()).hexdigest())]


def test_chat_is_native(spark, sf):
    plan = chat.op4_chat_format(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_quality_on_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in quality.op5_quality(spark, sf).collect()}
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    held = [(r.score, truth[i]) for i, r in got.items() if r.held_out and i in truth]
    low, high = [s for s, y in held if not y], [s for s, y in held if y]
    assert np.mean([a < b for a in low for b in high]) > 0.98 and np.mean([(s >= 0.3) == y for s, y in held]) > 0.95


def test_quality_edges(spark):
    kind = "doc_id long, text string, n_chars long"
    docs = spark.createDataFrame([(1, None, None), (2, "", 0), (2, "", 0), (None, "a b", 3), (3, "w " * 60000, 5)], kind).withColumn("stored", F.lit("x"))
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(docs, quality.train(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 0)], "doc_id long, quality int")
    assert quality.score(docs, quality.train(docs, one)).count() == 5
    assert quality.score(docs.limit(0), quality.train(docs, one)).count() == 0


def test_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    m = quality.Machine(0.1, rng.normal(size=quality.BUCKETS + quality.N_STATS), rng.normal(size=(quality.BUCKETS + quality.N_STATS, 8)), np.zeros(quality.N_STATS), np.ones(quality.N_STATS))
    bucket, stats = np.array([3, 9, 9, 40]), rng.normal(size=(1, quality.N_STATS))
    x = [(b, 0.5) for b in bucket] + [(quality.BUCKETS + k, v) for k, v in enumerate(np.clip(stats[0], -4, 4))]
    plain = 0.1 + sum(m.w[i] * a for i, a in x) + sum(m.v[i] @ m.v[j] * a * b for n, (i, a) in enumerate(x) for j, b in x[:n])
    assert abs(m.margin(bucket, np.array([0, 4]), stats)[0][0] - plain) < 1e-8


def _exact(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in good:
        if q % 100 == 0:
            out[q] = sorted((float(np.sqrt(((v - w) ** 2).sum())), i) for i, w in good if i != q)[:k]
    return out


def test_nearest_on_small_tables_is_exact(spark):
    """So few vectors that every tree ascends to all of them."""
    rng = np.random.default_rng(5)
    common = [float(np.float32(x)) for x in rng.normal(size=8)]
    rows = [(i, common) for i in range(0, 320, 5)] + [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(1, 60, 7)]
    rows += [(1000, None), (1100, [0.0] * 8), (1200, [float("nan")] + [1.0] * 7), (1300, [None] + [1.0] * 7), (1400, [float("inf")] + [1.0] * 7), (None, common), (400, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(100))
    got = {}
    for r in nearest.nearest(df, F.col("id") % 100 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert got == _exact(rows, 10)


def test_nearest_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, list(map(float, r.embedding))) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, got = _exact(rows, 10), {}
    for r in nearest.op8_nearest(spark, sf).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    hits = sum(i in got[q] for q, near in want.items() for _, i in near)
    assert hits >= 0.9 * sum(map(len, want.values())) and all(got[q].get(i, d) == d for q, near in want.items() for d, i in near)


def _scanned(monkeypatch, spark, rows, enough):
    """(recall, share of the vectors that a query's parts and prefixes hold) of a search over ``rows``."""
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    seen = spark.sparkContext.accumulator(0)
    plain = nearest._nearest

    def counting(k, levels):
        work = plain(k, levels)

        def run(entries, queries):
            strings = entries.column("string").to_numpy()
            for s, bits in zip(queries.column("string").to_pylist(), queries.column("bits").to_pylist()):
                first = s >> (levels - bits) << (levels - bits)
                seen.add(int(len(strings) if not bits else np.searchsorted(strings, first + (1 << (levels - bits))) - np.searchsorted(strings, first)))
            yield from work(entries, queries)

        return run

    monkeypatch.setattr(nearest, "_nearest", counting)
    got = {}
    for r in nearest.nearest(df, F.col("id") % 100 == 0, enough=enough).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q in range(0, len(rows), 100):
        far = ((rows - rows[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        near = set(np.argsort(far, kind="stable")[:10].tolist())
        hits, total = hits + len(near & got[q]), total + 10
    return hits / total, seen.value / len(range(0, len(rows), 100)) / len(rows)


def test_nearest_prunes_clusters(spark, monkeypatch):
    """Clustered vectors: under a tenth of them are looked at, counted once for every tree they are met in."""
    rng = np.random.default_rng(3)
    rows = np.repeat(rng.normal(size=(400, 64)), 50, axis=0) + rng.normal(size=(20_000, 64)) * 0.02
    recall, share = _scanned(monkeypatch, spark, rows, nearest.ENOUGH)
    assert recall >= 0.9 and share < 0.1


def test_nearest_ascends_deep_in_a_dense_cluster(spark, monkeypatch):
    """A third of all vectors in one cluster: trees stop at long prefixes, together, once they hold enough."""
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(9000, 8))
    rows[::3] = rows[0] + rng.normal(size=(3000, 8)) * 1e-3
    recall, share = _scanned(monkeypatch, spark, rows, 1500)
    assert recall >= 0.9 and share < 0.5


def test_nearest_of_few(spark):
    kind = "vec_id long, embedding array<float>"
    assert nearest.nearest(spark.createDataFrame([], kind), F.col("id") % 100 == 0).count() == 0
    two = nearest.nearest(spark.createDataFrame([(100, [1.0, 0.0]), (100, [1.0, 0.0]), (3, [0.0, 1.0])], kind), F.col("id") % 100 == 0).collect()
    assert [tuple(r)[:3] for r in two] == [(100, 1, 3)]


def test_pipeline_stages(spark):
    import brute
    import corpus_pipeline
    from test_near_copies import standing
    from tokenizers import Tokenizer

    from sparloom.llm import packing

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        tables.append(spark.createDataFrame(stage(spark, tables[-1], sf).collect(), docs.schema))
    rows = [[tuple(r) for r in t.collect()] for t in tables]
    assert all(t.columns == docs.columns for t in tables)
    assert set(rows[1]) <= set(rows[0]) and {r[0] for r in rows[2]} == standing(rows[1]) and set(rows[2]) <= set(rows[1])
    cut = {r[0]: x for r, x in zip(rows[2], brute.windows_before(rows[2]))}
    assert len(rows[3]) == len(rows[2]) and all(brute.sha(" ".join(brute.SPACE_WORD.findall(r[1]))) == cut[r[0]][2] and r[4] == len(r[1]) for r in rows[3])
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert {r[0] for r in rows[4]} == {r[0] for r, x in zip(rows[3], brute.contamination(rows[3], items)) if not x[4]}
    out = sorted(tuple(r)[:5] for r in corpus_pipeline.run(spark, sf).collect())
    assert out == sorted(brute.pieces(rows[4], Tokenizer.from_file(packing.default_tokenizer())))


def test_stages_with_null_and_shared_ids(spark, sf):
    import brute

    from sparloom.llm import decontaminate, simhash, substring_dedup

    leak = " ".join(r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").limit(1).collect())
    rows = brute.awkward()
    rows += [(None, leak, None, None, len(leak)), (16, leak, None, None, len(leak)), (16, leak, None, None, len(leak))]
    df = spark.createDataFrame(rows, brute.SCHEMA)
    clean = sorted(map(tuple, decontaminate.stage(spark, df, sf).collect()), key=repr)
    assert clean == sorted((r for r in rows if r[1] != leak), key=repr)
    one = [tuple(r) for r in simhash.stage(spark, df, sf).collect()]
    groups = {brute.fingerprint(r[1]) for r in rows}
    assert set(one) <= set(rows) and len(one) == len(set(one)) <= len(groups) and not [r for r in one if r[0] == 14]
    assert sum(r[1] == leak for r in one) == 1 and sum(not (r[1] or "").strip() for r in one) == 1
    assert substring_dedup.stage(spark, df, sf).count() == len(rows)
    for stage in (decontaminate.stage, simhash.stage, substring_dedup.stage):
        assert stage(spark, df.limit(0), sf).count() == 0


def test_first_and_last_stage_on_awkward_rows(spark, sf):
    import brute
    from tokenizers import Tokenizer

    from sparloom.llm import packing

    rows = brute.awkward()
    df = spark.createDataFrame(rows, brute.SCHEMA)
    kept = [tuple(r) for r in quality.stage(spark, df, sf).collect()]
    assert quality.stage(spark, df, sf).columns == df.columns and set(kept) <= set(rows) and all(kept.count(r) in (0, rows.count(r)) for r in rows)
    more = quality.stage(spark, df.withColumns({"stored": F.lit("x"), "body": F.lit(1), "score": F.lit(0.0)}), sf)
    assert more.count() == len(kept) and more.columns[-3:] == ["stored", "body", "score"]
    assert quality.stage(spark, df.limit(0), sf).count() == 0
    out = sorted((tuple(r)[:5] for r in packing.stage(spark, df.withColumn("piece", F.lit("x")), sf).collect()), key=repr)
    assert out == sorted(brute.pieces(rows, Tokenizer.from_file(packing.default_tokenizer())), key=repr)
    assert packing.stage(spark, df.limit(0), sf).count() == 0


def test_registry():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
