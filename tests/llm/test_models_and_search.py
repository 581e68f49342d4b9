"""The random fields against brute force and held-out labels, search against plain scoring, the pipeline stage by stage."""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from hackney.llm import chain, html_extraction, registry, search, toxicity
from tests.llm.conftest import rows_of


def paths(model, leads):
    for tags in itertools.product((0, 1), repeat=len(leads)):
        score = model.start[tags[0]] + sum(model.moves[a, b] for a, b in zip(tags, tags[1:]))
        yield tags, score + sum(lead for lead, tag in zip(leads, tags) if tag)


def test_marginals_and_best_paths_are_exact():
    draw = np.random.default_rng(0)
    model = chain.Chain(np.zeros((0, 2)), draw.normal(size=2), draw.normal(size=(2, 2)))
    leads, cuts = 3 * draw.normal(size=23), [0, 5, 6, 15, 23]
    begins = np.isin(np.arange(23), cuts)
    found = chain.pair_marginals(model, leads, begins)
    best = chain.best_tags(model, [np.stack([np.zeros(b - a), leads[a:b]], axis=1) for a, b in zip(cuts, cuts[1:])])
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        every = list(paths(model, leads[a:b]))
        weights = np.exp([s for _, s in every])
        assert found[a:b] == pytest.approx((np.array([t for t, _ in every]) * weights[:, None]).sum(0) / weights.sum())
        assert tuple(best[i]) == max(every, key=lambda p: p[1])[0]


def test_padded_posteriors_are_exact():
    draw = np.random.default_rng(1)
    model = chain.Chain(np.zeros((1, 2)), draw.normal(size=2), draw.normal(size=(2, 2)))
    scores = draw.normal(size=(2, 6, 2))
    alone, _ = chain._posteriors(model, scores, np.array([6, 3]))
    for row, length in ((0, 6), (1, 3)):
        every = [(t, s + sum(scores[row, :length, 0])) for t, s in paths(model, scores[row, :length, 1] - scores[row, :length, 0])]
        weights = np.exp([s for _, s in every])
        assert alone[row, :length, 1] == pytest.approx((np.array([t for t, _ in every]) * weights[:, None]).sum(0) / weights.sum())


def held_out(doc_id):
    return crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def scored(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in registry.table(spark, folder, "labels").collect()}
    documents = registry.table(spark, folder, "documents").join(registry.table(spark, folder, "labels").select("doc_id"), "doc_id")
    rows = toxicity.score(documents, registry.table(spark, folder, "labels"), sample=400)
    return labels, {r["doc_id"]: r for r in rows.join(documents.select("doc_id", "text"), "doc_id").collect()}


def test_toxic_documents_are_found(scored):
    labels, rows = scored
    tested = [i for i in rows if held_out(i)]
    toxic = [i for i in tested if labels[i] == 1]
    assert len(toxic) > 40
    right = sum((rows[i]["score"] >= 0.5) == (labels[i] == 1) for i in tested)
    # A few of the junk documents are labelled toxic without any sign of it.
    assert right / len(tested) > 0.975 and sum(rows[i]["score"] >= 0.5 for i in toxic) / len(toxic) > 0.9


def test_offending_spans_lie_in_the_texts(scored):
    _, rows = scored
    for r in rows.values():
        assert r["spans"] or r["score"] < 0.5
        assert all(re.fullmatch(r"\w.*\w|\w", r["text"][s["start"] : s["end"]], re.DOTALL) for s in r["spans"])


def test_toxicity_query(spark, sf_dir):
    rows = registry.QUERIES["op5_toxicity"](spark, sf_dir).collect()
    assert len(rows) == registry.table(spark, sf_dir, "documents").count()
    assert all(r["held_out"] == held_out(r["doc_id"]) and r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)


def test_toxicity_of_odd_documents(spark, odd_documents, clashing, documents):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in toxicity.score(odd_documents, none).collect()} == {0.0}
    assert toxicity.drop_toxic(odd_documents, none).count() == 11
    draw = random.Random(11)
    words = ["".join(draw.choice("aeioulmnrst") for _ in range(draw.randint(2, 8))) for _ in range(900)]
    plain = [(i, " ".join(draw.choices(words, k=40)), "s") for i in range(100, 400)]
    bad = [(i, " ".join([*draw.choices(words, k=30), f"vileword{i % 7}", "you", f"vilething{i % 5}"]), "s") for i in range(400, 700)]
    known = spark.createDataFrame([(i, 1, int(i >= 400)) for i in range(100, 700)] + [(None, 1, 1), (4, 1, None)], "doc_id bigint, quality int, toxic int")
    every = odd_documents.unionByName(documents(plain + bad))
    told = {r["doc_id"]: r["score"] for r in toxicity.score(clashing(every), known).collect()}
    assert all(told[i] < 0.5 for i in (None, 1, 2, 3, 4, 5, 6, 7, 8, 9)) and told[1] == told[2] == 0.0
    assert all((told[i] >= 0.5) == (i >= 400) for i in range(100, 700))
    left = toxicity.drop_toxic(clashing(every), known)
    assert left.columns == clashing(every).columns and left.count() == 311
    assert toxicity.score(every.limit(0), known).count() == 0


PAGE = """<html><head><title>t</title><script>var t="</p>";</script></head><body><nav><ul><li><a href=x>Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><article><h1>A &lt; B</h1><p><b>First   para<br>of it.<p>Second &amp; last.
<div class="ad">Buy now!</div><section class="comments"><div class="comment"><p>I disagree with all of this.</p></div></section>
</article><aside class="sidebar"><p>Related stories are here.</p></aside><form><label>Mail</label></form><footer>&copy; x</footer>"""


@pytest.fixture(scope="module")
def pages(spark):
    return registry.table(spark, "/root/testdata/sf0.01", "pages")


def article_of(page):
    inside = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.DOTALL)[1]
    import html

    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inside.replace("<br>", " ")))
    return [t for t in (" ".join(html.unescape(p).split()) for p in parts) if t]


def test_articles_of_every_page(spark, pages):
    rows = {r["page_id"]: r for r in registry.QUERIES["op6_html_extraction"](spark, "/root/testdata/sf0.01").collect()}
    for r in pages.collect():
        expected = "\n".join(article_of(r["html"]))
        assert rows[r["page_id"]]["text"] == expected and rows[r["page_id"]]["n_chars"] == len(expected)


def test_other_layouts(pages):
    model = html_extraction.Extractor(html_extraction.fit([r["html"] for r in pages.limit(100).collect()]))
    other = """<body><div id=header>Site</div><div class='content'><h1>T</h1><p>Para one is here.</p><blockquote>Quoted.</blockquote>
    <table><tr><td>cell<td>two</table><ul><li>item one<li>item two</ul></div><div class='comments'><p>Nice text, thanks.</p></div>"""
    assert model.extract([PAGE, other, "", "plain <p"]) [:3] == [
        ["A < B", "First para of it.", "Second & last."],
        ["T", "Para one is here.", "Quoted.", "cell", "two", "item one", "item two"],
        [],
    ]


def test_deep_and_long_pages_cost_no_more_than_their_length(spark):
    import time
    import tracemalloc

    for page, count in (("<div>a" * 100_000, 100_000), ("<li><div>b" * 50_000, None), ("<p>c" * 200_000, 200_000), ("</b2>x<td>" * 50_000, None)):
        tracemalloc.start()
        begun = time.process_time()
        blocks = html_extraction.leaf_blocks(page)
        took, peak = time.process_time() - begun, tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert (count is None or len(blocks) == count) and took < 20 and peak < 500e6
    whole = ("html", "body", "div x", "div", "div x", "section", "div", "div")
    assert sorted(html_extraction.path_features(whole)) == sorted(html_extraction.path_features(html_extraction.leaf_blocks(
        "<html><body><div class=x><div><div class=x><section><div><div>t")[0].path))


def test_one_long_sequence_widens_no_others():
    from hackney.llm import chain

    draw = np.random.default_rng(4)
    field = chain.Chain(np.zeros((1, 2)), draw.normal(size=2), draw.normal(size=(2, 2)))
    sequences = [draw.normal(size=(n, 2)) for n in (0, 1, 2, 3, 5, 8, 300, 0, 1, 70)]
    for sequence, path in zip(sequences, chain.best_tags(field, sequences), strict=True):
        best, came = None, []
        for scores in sequence:
            options = (field.start + scores)[None] if best is None else best[:, None] + field.moves + scores
            came.append(options.argmax(axis=0))
            best = options.max(axis=0)
        expected = [int(best.argmax())] if len(sequence) else []
        for back in came[:0:-1]:
            expected.insert(0, int(back[expected[0]]))
        assert path.tolist() == expected


def test_a_corpus_that_names_its_articles(spark):
    def page(i):
        story = " ".join(f"Sentence {i} of the story goes on and on, as stories do, until line {k} ends." for k in range(6))
        return (i, f"u{i}", f"<html><body><div class='menu'><ul><li><a href=x>Home</a><li><a href=y>News {i}</a></ul></div><div class='post-content post'><p>{story}</p><p>More of {i}. {story}</p></div><div class='footer'>All rights reserved (c) {i}</div></body></html>", story)

    made = [page(i) for i in range(60)]
    frame = spark.createDataFrame([m[:3] for m in made], "page_id bigint, url string, html string")
    for row in html_extraction.extract_text(frame).collect():
        story = made[row["page_id"]][3]
        assert row["blocks"] == [story, f"More of {row['page_id']}. {story}"]


def test_leaf_blocks():
    told = [(b.text, b.path) for b in html_extraction.leaf_blocks("<div Class='A b'>x<p>y <i>z</i><!-- <p>n</p> --> w<li>1<li>2</div>t &am")]
    assert told == [("x", ("div a b",)), ("y z w", ("div a b", "p")), ("1", ("div a b", "li")), ("2", ("div a b", "li")), ("t &am", ())]


def test_odd_pages(spark, pages):
    odd = spark.createDataFrame([(None, None, None), (-1, "u", ""), (-2, "u", "<script>never closed"), (-3, None, "&amp" * 5)], "page_id bigint, url string, html string")
    more = pages.select("page_id", "url", "html").unionByName(odd).select("*", F.lit("x").alias("HTML"), F.lit(1).alias("blocks"))
    found = {r["page_id"]: r["blocks"] for r in html_extraction.extract_text(more).where("page_id < 0 OR page_id IS NULL").collect()}
    assert found[None] == found[-1] == found[-2] == [] and len(found) == 4
    assert all(r["blocks"] == [] for r in html_extraction.extract_text(odd).collect())
    assert html_extraction.extract_text(odd.limit(0)).count() == 0


def plain_search(documents, queries, k):
    """BM25 by scoring every document for every query."""
    held = {i: Counter(re.findall(r"[^\W_]+", (t or "").lower())) for i, t in documents}
    mean = sum(sum(c.values()) for c in held.values()) / len(held)
    df = Counter(t for c in held.values() for t in c)
    told = []
    for q, text in queries:
        asked = Counter(re.findall(r"[^\W_]+", (text or "").lower()))
        scores = []
        for i, c in held.items():
            norm = 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)
            s = sum(n * math.log(1 + (len(held) - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * 2.2 / (c[t] + norm) for t, n in asked.items() if c[t])
            if s > 0:
                scores.append((-round(s, 6), i))
        told += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(told)


@pytest.mark.parametrize(("shard_bytes", "memory"), [(1 << 12, 1 << 30), (1 << 24, 1 << 30), (1 << 24, 1 << 10)])
def test_search_is_exact(spark, sf_dir, monkeypatch, shard_bytes, memory):
    monkeypatch.setattr(search, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(search, "SHARD_MEMORY", memory)
    rows = [(r["doc_id"], r["text"]) for r in registry.table(spark, sf_dir, "documents").collect()]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    queries = [(i, t) for i, t in rows if i % 25 == 0]
    asked = spark.createDataFrame(queries, "query_id bigint, text string")
    found = sorted(map(tuple, search.top_k(frame, asked, k=7).collect()))
    expected = plain_search(rows, queries, 7)
    assert [f[:3] for f in found] == [e[:3] for e in expected]
    assert [f[3] for f in found] == pytest.approx([e[3] for e in expected], abs=2e-6)


def test_queries_in_blocks_are_answered_alike(spark, sf_dir, monkeypatch):
    whole = rows_of(registry.QUERIES["op10_top_k_search"](spark, sf_dir))
    monkeypatch.setattr(search, "QUERY_BYTES", 2000)
    assert rows_of(registry.QUERIES["op10_top_k_search"](spark, sf_dir)) == whole


def test_search_of_odd_documents(spark, odd_documents, clashing):
    queries = spark.createDataFrame([(1, "one two"), (2, None), (3, ""), (4, "absent"), (None, "one"), (5, "id délta0")], "query_id bigint, text string")
    found = rows_of(search.top_k(clashing(odd_documents), queries, k=2))
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    # The plain search knows documents by their places; equal scores rank by id, nulls last.
    by_id = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    plain = plain_search([(i, t) for i, (_, t) in enumerate(by_id)], [(q, t) for q, t in queries.collect() if q is not None], 2)
    assert [(q, r, i, s) for q, r, i, s in found] == [(q, r, by_id[i][0], pytest.approx(s, abs=2e-6)) for q, r, i, s in plain]
    assert search.top_k(odd_documents.limit(0), queries).count() == 0
    assert search.top_k(odd_documents, queries.limit(0)).count() == 0


def test_memory_of_a_shard_is_as_foretold():
    """Many short texts of common words, the most that common terms can take."""
    import tracemalloc

    count, terms = 200_000, 160
    owner = np.repeat(np.arange(count), 4)
    number = np.random.default_rng(2).integers(0, terms, 4 * count)
    number[::2] = owner[::2] % 24  # in every 24th document, so common
    tracemalloc.start()
    shard = search.Shard(owner, number, np.full(count, 4), terms, 4.0)
    place, score = shard.best(np.arange(20), np.ones(20), 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (shard.row >= 0).sum() >= 24 and peak < search.memory_of(np.bincount(number, minlength=terms), 4 * count, count)
    times = np.bincount(owner * terms + number, minlength=count * terms).reshape(count, terms)[:, :20]
    whole = (times * 2.2 / (times + 1.2)).sum(axis=1)
    least = np.sort(whole)[-10]
    assert set(shard.original[place[score >= least - 1e-9]]) == set(np.flatnonzero(whole >= least - 1e-9))


def test_documents_are_read_once_for_all_queries(spark, tmp_path, monkeypatch):
    """However many blocks the queries make, their plans read stored slices and no document."""
    monkeypatch.setattr(search, "QUERY_BYTES", 40)
    rows = [(i, f"word{i % 7} word{i % 5} all") for i in range(60)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents"))
    documents = spark.read.parquet(str(tmp_path / "documents"))
    found = search.top_k(documents, documents.where("doc_id < 12").withColumnRenamed("doc_id", "query_id"), k=3)
    plan = found._jdf.queryExecution().toString()
    assert plan.count("MapInArrow") > 4 and "FileScan" not in plan and str(tmp_path) not in plan
    assert [tuple(r)[:3] for r in sorted(found.collect())] == [e[:3] for e in plain_search(rows, rows[:12], 3)]


def test_queries_at_a_time_score_like_one_by_one():
    """Documents and queries of two languages, so that blocks of one cannot reach the floors of the other."""
    draw = np.random.default_rng(5)
    count, half, k = 3000, 40, 10
    lengths = draw.integers(5, 60, count)
    owner = np.repeat(np.arange(count), lengths)
    # Two languages of common terms, and rare terms of both.
    number = np.where(draw.random(len(owner)) < 0.2, 2 * half + draw.integers(0, 400, len(owner)), draw.integers(0, half, len(owner)) + half * (owner % 2))
    n_terms, mean = 2 * half + 400, lengths.mean()
    shard = search.Shard(owner, number, lengths, n_terms, mean)
    assert (shard.row >= 0).sum() >= 2 * half and (shard.row[2 * half :] < 0).any()
    asked = [np.unique(np.concatenate([draw.integers(0, half, 12) + half * (q % 2), 2 * half + draw.integers(0, 400, 9)])) for q in range(50)]
    asked[7] = asked[7][:0]
    weights = [draw.random(len(t)) * 30 for t in asked]
    times = np.bincount(owner * n_terms + number, minlength=count * n_terms).reshape(count, n_terms)
    impacts = times * 2.2 / (times + 1.2 * (0.25 + 0.75 * lengths / mean)[:, None])
    bounds = np.cumsum([0, *map(len, asked)])
    floor = np.array([np.sort(impacts[:, t] @ w)[-k] for t, w in zip(asked, weights)])
    for floors in (np.zeros(50), floor - 1e-7, np.where(np.arange(50) % 3, floor, 0.0)):
        whose, place, score = shard.best_of(bounds, np.concatenate(asked), np.concatenate(weights), k, floors)
        for q, (t, w) in enumerate(zip(asked, weights)):
            whole, mine = impacts[:, t] @ w, shard.original[place[whose == q]]
            assert score[whose == q] == pytest.approx(whole[mine], abs=1e-9)
            assert set(np.flatnonzero((whole >= floor[q]) & (whole > 0))) <= set(mine) and len(mine) < 3 * k
    pruned = shard.best_of(bounds[:2], asked[0], weights[0], k, np.array([1e9]))
    assert all(len(x) == 0 for x in pruned)


@pytest.mark.parametrize("by_id", [True, False])
def test_the_best_so_far(by_id):
    best = search.Best(2, 2, by_id)
    best.add(np.array([0, 0, 1]), pa.array([5, None, 9]), np.array([1.0, 1.0, 3.0]))
    best.add(np.array([1, 0, 0]), pa.array([8, 4, 3]), np.array([4.0, 1.0, 0.5]))
    best.add(np.array([1]), pa.array([7]), np.array([5.0]))
    found = sorted(zip(best.whose.tolist(), best.score.tolist(), best.ids.to_pylist()), key=repr)
    ties = [] if by_id else [(0, 1.0, None)]
    assert found == [(0, 1.0, 4), (0, 1.0, 5), *ties, (1, 4.0, 8), (1, 5.0, 7)] and best.floor.tolist() == [1.0, 4.0]


def test_terms_by_bytes():
    """Terms cut by bytes are those of the pattern, also where other characters than ASCII stand between them."""
    draw = random.Random(4)
    texts = ["", " ", "_a_b_", "İstanbul ΣΑΣ ß²", "日本、語", "a\u2019b\u00a0c\u2003d", "x\u0302y"]
    texts += ["".join(draw.choices("aB9_ .-\n\t\x1c\x85 \u00a0éßİΣ日²½ⅷ\u0301\u200b–𝒳٣", k=draw.randint(0, 30))) for _ in range(500)]
    told = search.packed(pa.array(range(len(texts))), texts, 1)
    terms = sorted({t for text in texts for t in search.terms_of(text)})
    (part,) = search.unpacked([told], pa.array(terms[::2], pa.string()))
    assert part.lengths.tolist() == [len(search.terms_of(t)) for t in texts]
    held = [(i, terms.index(t) // 2, n) for i, text in enumerate(texts) for t, n in Counter(search.terms_of(text)).items() if t in terms[::2]]
    assert sorted(zip(part.owner.tolist(), part.number.tolist(), part.times.tolist())) == sorted(held)


# --- the pipeline


def test_stages_are_as_dealt():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "MinHash near-dedup", "mixing sources to target weights", "SentencePiece encoding and decoding",
    ]
    assert entry.queries()["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None


def test_pipeline_against_brute_force(spark, sf_dir, tmp_path):
    import sentencepiece

    from hackney.llm import mixing
    from tests.llm.test_dedup_and_mixing import LOWER, classes_of

    docs = {r["doc_id"]: r["text"] for r in registry.table(spark, sf_dir, "documents").collect()}
    scores = {r["doc_id"]: r["predicted"] for r in registry.QUERIES["op5_toxicity"](spark, sf_dir).collect()}
    docs = {i: t for i, t in docs.items() if not scores[i]}
    last: dict[str, int] = {}
    for i in sorted(docs):
        last[docs[i].translate(LOWER)] = i
    docs = {i: docs[i] for i in last.values()}
    classes = classes_of(docs)
    docs = {i: t for i, t in docs.items() if classes[i] == i}
    kept = registry.table(spark, sf_dir, "documents").where(F.col("doc_id").isin(*docs))
    times = Counter({r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix_sizes(kept).collect() if r["size"]})
    library = sentencepiece.SentencePieceProcessor(model_file=registry.PIECES)
    expected = sorted((i, tuple(library.encode(docs[i]))) for i, n in times.items() for _ in range(n))
    found = sorted((r["doc_id"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert found == expected


def test_stages_take_odd_documents(spark, sf_dir, odd_documents, clashing):
    docs = clashing(odd_documents)
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        told = stage(spark, docs, sf_dir)
        if n < 4:
            assert told.columns == docs.columns
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
        assert told.count() > 0
