"""Language, quality, language model and extraction against plain versions."""

from __future__ import annotations

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linewatch.llm import extraction, language, lm, quality, queries
from linewatch.llm.common import id_text_crc, utf8

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_held_out_languages_are_told(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op4_language_bitmask(spark, sf).collect()
    assert len(rows) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.97


def test_filter_contains_what_it_learned():
    codes = np.random.default_rng(2).integers(0, 1 << 62, 30_000)
    owner = np.arange(len(codes)) % 3
    filter_ = language.Filter.build(["a", "b", "c"], owner, codes)
    assert ((filter_.containing(codes) >> owner) & 1).all()
    strange = filter_.containing(np.random.default_rng(3).integers(0, 1 << 62, 200_000))
    for i in range(3):
        assert abs(((strange >> i) & 1).mean() - filter_.false[i]) < 0.001


def test_languages_of_odd_rows(odd_docs, no_docs):
    model = language.learn(odd_docs)
    rows = language.predict(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: (r.lang_pred, r.score) for r in rows if r.doc_id not in (None, 2)}
    assert by[3] == by[4] == by[5] == by[8] == ("und", 0.0)
    assert by[1][0] == "en" and by[-9][0] == "de" and by[7][0] != "und"
    kept = odd_docs.where(language.is_known(model))
    assert kept.columns == odd_docs.columns and not [r for r in kept.collect() if r.text is None or not re.search(r"[^\W\d_]", r.text)]
    nothing = language.learn(no_docs)
    assert nothing.languages == [] and {r.lang_pred for r in language.predict(odd_docs, nothing).collect()} == {"und"}
    assert language.predict(no_docs, model).collect() == []


def test_many_languages_are_told(spark):
    rng = random.Random(6)
    docs = [(i, "".join(chr(0x4E00 + 20 * i + rng.randrange(20)) for _ in range(60)), f"x{i}") for i in range(150)]
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = language.learn(table)
    assert len(model.languages) == 150
    assert {(r.doc_id, r.lang_pred) for r in language.predict(table, model).collect()} == {(i, k) for i, _, k in docs}


UNLEARNED = [
    "Questa è una frase in italiano che racconta la storia di un piccolo paese tra le montagne, dove la gente vive ancora come una volta.",
    "O rio corre devagar entre as montanhas e as pessoas da aldeia falam uma língua antiga que já não se ouve em mais nenhum lugar do país.",
    "La ciutat es va despertar amb el so de les campanes i la gent va sortir al carrer per celebrar la festa major amb música i balls.",
    "De kleine jongen liep langzaam door het bos en dacht aan zijn moeder die thuis op hem wachtte met een warme maaltijd en een kopje thee.",
    "Suomalainen kirjallisuus on saanut paljon vaikutteita muista maista ja sen historia on pitkä ja monivaiheinen kertomus kansasta.",
]


def test_texts_in_no_learned_language_go(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    text = {k: [r.text for r in docs.where(F.col("lang") == k).orderBy("doc_id").collect()] for k in ("de", "en", "es", "fr")}
    mixed = [" ".join(x[:400] for x in pair) for pair in zip(text["de"][:9], text["es"][:9], strict=True)]
    short = [w for k in text for w in text[k][0].split()[:3]]
    planted = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate([*UNLEARNED, *mixed, *short])], docs.schema)
    kept = corpus_pipeline.known_language(spark, docs.unionByName(planted), sf_dir)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} | {-1 - i for i in range(len(UNLEARNED), len(UNLEARNED + mixed + short))}
    for left in ("es", "fr"):
        others = docs.where(F.col("lang") != left)
        model = language.learn(others)
        known = language.is_known(model, least=language.least_shares(others, model))
        long = docs.where((F.col("lang") == left) & (F.length("text") > 200))
        assert long.count() > 9 and long.where(known).count() == 0


def plain_counts(text) -> list[int]:
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)]


def test_counts_equal_plain_counts():
    rng = random.Random(3)
    texts = ["", None, "\n", "a\na\n\n a\na ", "x " * 30, "\n\nq\n", "é é é", *("".join(rng.choice("ab \n#é\x0b") for _ in range(rng.randint(0, 200))) for _ in range(400))]
    found = quality.counts(*utf8(pa.array(texts)))
    assert [[int(found[c][i]) for c in quality.COUNTS] for i in range(len(texts))] == [plain_counts(t) for t in texts]


def test_verdicts_follow_the_rules(spark, sf_dir, sf_docs):
    text = {r.doc_id: r.text for r in sf_docs.collect()}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    grams = {d: collections.Counter(t.encode()[i : i + 3] for i in range(len(t.encode()) - 2)) for d, t in text.items()}
    tables = []
    for ids in (grams, good & set(grams)):
        table = np.zeros(1 << quality.BUCKET_BITS)
        for d in ids:
            for g, n in grams[d].items():
                bucket, _ = quality.buckets(np.frombuffer(g, np.uint8), np.array([0, 3]))
                table[bucket] += n
        tables.append((table + 1) / (table.sum() + len(table)))
    rows = queries.op7_target_ratio(spark, sf_dir).collect()
    assert len(rows) == len(text)
    for r in rows:
        n = plain_counts(text[r.doc_id])
        assert [r[c] for c in quality.COUNTS] == n
        assert r.base_failed == (n[0] < 20 or 100 * n[4] > 30 * n[0])
        ratio = sum(k * math.log(tables[1][b] / tables[0][b]) for g, k in grams[r.doc_id].items() for b in quality.buckets(np.frombuffer(g, np.uint8), np.array([0, 3]))[0])
        assert r.ratio == pytest.approx(ratio / max(1, grams[r.doc_id].total()), abs=1e-9)
        assert r.kept == (not r.base_failed and r.ratio >= quality.LEAST_RATIO)
    quality_of = {r.doc_id: r.quality for r in labels.collect()}
    told = [r.kept == (quality_of[r.doc_id] == 1) for r in rows if r.doc_id in quality_of and not r.base_failed]
    assert sum(told) / len(told) > 0.97


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (6, 1), (None, 1), (5, None), (4, 0)], "doc_id long, quality int")
    rows = quality.quality(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(not r.kept for r in rows if not r.n_words)
    assert odd_docs.where(quality.is_good(odd_docs, labels)).columns == odd_docs.columns
    assert all(r.ratio == 0 for r in quality.quality(odd_docs, labels.limit(0)).collect())
    assert quality.quality(no_docs, labels).collect() == []


def plain_tokens(text) -> list[str]:
    return [*WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")), "\0end"]


def test_scores_equal_a_plain_model(spark, sf_dir, sf_docs):
    docs = sf_docs.select("doc_id", "text", (F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(lm.HELD_ONE_IN)) == 0).alias("held")).collect()
    learns = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 != 1 for r in docs}
    tokens = {r.doc_id: plain_tokens(r.text) for r in docs}

    def count(ids):
        one, two, start = collections.Counter(), collections.Counter(), 0
        for d in ids:
            one.update(tokens[d])
            two.update(zip(["\0start", *tokens[d]], tokens[d], strict=False))
            start += 1
        return one, two, start

    def context(one, start, w):
        return start if w == "\0start" else one[w]

    trained = [d for d in tokens if learns[d]]
    held = [r.doc_id for r in docs if r.held and learns[r.doc_id]]
    one, two, start = count(trained)
    total, types = sum(one.values()), len(one)
    rest = count([d for d in trained if d not in set(held)])
    rest_total = sum(rest[0].values())
    seen = []
    for d in held:
        for v, w in zip(["\0start", *tokens[d]], tokens[d], strict=False):
            c = context(rest[0], rest[2], v)
            seen.append((int(lm.context_bucket(np.array([c]))[0]), rest[1][v, w] / max(c, 1), rest[0][w] / rest_total))
    bucket, p2, p1 = (np.array(x) for x in zip(*seen, strict=True))
    weights = np.full((lm.CONTEXTS, 3), 1 / 3)
    weights[0] = 0, 0.5, 0.5
    for _ in range(lm.MOST_ROUNDS):
        parts = weights[bucket] * np.stack((p2, p1, np.full(len(p1), 1 / (types + 1))), axis=1)
        parts /= parts.sum(1, keepdims=True)
        sums = np.ones((lm.CONTEXTS, 3))
        sums[0, 0] = 0
        np.add.at(sums, bucket, parts)
        new = sums / sums.sum(1, keepdims=True)
        moved = np.abs(new - weights).max()
        weights = new
        if moved < lm.SETTLED:
            break
    rows = queries.op9_deleted_interpolation(spark, sf_dir).collect()
    assert len(rows) == len(tokens)
    for r in rows:
        own = tokens[r.doc_id]
        base = sum(math.log10((one[w] + 0.5) / (total + 0.5 * (types + 1))) for w in own)
        score = 0.0
        for v, w in zip(["\0start", *own], own, strict=False):
            c = context(one, start, v)
            a, b, u = weights[int(lm.context_bucket(np.array([c]))[0])]
            score += math.log10(a * two[v, w] / max(c, 1) + b * one[w] / total + u / (types + 1))
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not learns[r.doc_id], len(own), sum(one[w] > 0 for w in own), total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-6)
    outside = [r for r in rows if r.held_out]
    assert sum(r.score for r in outside) > sum(r.base_score for r in outside)


def test_scores_of_odd_rows(odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 20)
    rows = lm.score(odd_docs, id_text_crc("doc_id") % 5 != 1).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in rows) == sorted((str(r.doc_id), len(plain_tokens(r.text))) for r in odd_docs.collect())
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 2)
    again = lm.score(odd_docs, id_text_crc("doc_id") % 5 != 1).collect()
    assert sorted((str(r.doc_id), round(r.score, 9), r.n_known) for r in again) == sorted((str(r.doc_id), round(r.score, 9), r.n_known) for r in rows)
    assert {r.train_tokens for r in lm.score(odd_docs, F.lit(False)).collect()} == {0}
    assert lm.score(no_docs, F.lit(True)).collect() == []


def plain_lcs(a, b) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 25))] for _ in range(2))
        found = sorted(extraction.shared(a, b))
        assert len(found) == plain_lcs(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in found)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><header><h2>Site</h2></header>
<nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="ad box">Buy</div>{body}<section id="comments"><p>First!</p></section>
<form><input name=q><button>Go</button></form><footer>&copy; site &middot; now</footer>"""


def test_main_text_of_pages(spark):
    article = "<article><h1>A &amp; B</h1><p><b>One\n  two&nbsp;x<br>three<p>Four &lt;5&gt;<aside>Side</aside><div class='notice'>Note</div></p>shared line</article>"
    other = "<article><p>Other</p><p>shared line</p></article>"
    plain = "<div>Template</div><p>Only {n}</p><div>Template end</div>"
    pages = [
        (1, "http://a.org/x/1", PAGE.format(body=article)),
        (2, "http://a.org/x/2", PAGE.format(body=other)),
        (3, "http://b.org/1", PAGE.format(body=plain.format(n=1))),
        (4, "http://b.org/2?q", PAGE.format(body=plain.format(n=2))),
        (5, None, None),
        (6, "http://c.org/", ""),
        (7, "http://d.org/1", PAGE.format(body="<p>Copy</p>")),
        (7, "http://d.org/1", PAGE.format(body="<p>Copy</p>")),
        (None, None, "<p>No address"),
        (8, "http://e.org/", "<main>" + "<p>long</p>" * 20_000 + "<!-- open"),
    ]
    table = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, host string").coalesce(1)
    rows = extraction.extract(table).collect()
    text = {r.page_id: r.text for r in rows}
    assert len(rows) == len(pages)
    assert text[1] == "A & B\nOne two x three\nFour <5>\nshared line" and text[2] == "Other\nshared line"
    assert text[3] == "Only 1" and text[4] == "Only 2" or {text[3], text[4]} <= {"Only 1", "Only 2", "Template\nOnly 1\nTemplate end", "Template\nOnly 2\nTemplate end"}
    assert text[5] == text[6] == "" and text[7] == "Copy" and text[None] == "No address" and text[8] == "\n".join(["long"] * 20_000)
    assert extraction.extract(table.limit(0)).collect() == []


def test_articles_of_the_table_are_whole(spark, sf_dir):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in queries.op6_url_differencing(spark, sf_dir).collect():
        inside = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        lines = [" ".join(html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        assert r.text == "\n".join(x for x in lines if x) and r.n_chars == len(r.text)


def test_pipeline_stages(spark, sf_dir, odd_docs, no_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir).cache()
        assert out.columns == docs.columns and out.exceptAll(docs).count() == 0
        kept[name] = {r.doc_id for r in out.collect()}
        docs = out
    verdict = {r.doc_id: r.kept for r in queries.op7_target_ratio(spark, sf_dir).collect()}
    assert kept["language"] == set(verdict)
    assert kept["quality"] == {d for d in kept["language"] if verdict[d]}
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()} == kept["near_duplicates"]
    for frame in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, sf_dir).columns == frame.columns
        assert corpus_pipeline.STAGES[-1][1](spark, frame, sf_dir).columns[0] == "doc_id"


def test_neighbours_are_found_over_the_edges_of_tasks(spark):
    pages = [(100 * h + i, f"http://h{h}.org/{i // 3}/{i}", f"<div>Top {h}</div><p>Group {i // 3}</p><p>Only {h}/{i}</p>") for h, n in enumerate([1, 2, 3, 5, 20]) for i in range(n)]
    pages += [(None, None, "<p>No address"), (900, None, "<p>No address"), (901, "http://q.org/€\"\\1", "<i>Q</i><p>1"), (None, "http://q.org/€\"\\1", "<i>Q</i><p>2")]
    order = sorted(((u or "").split("/", 3)[2] if u else "", "/" + u.split("/", 3)[3] if u else "", i or -1, u, h) for i, u, h in pages)
    plain = []
    for at, (host, path, i, _, text) in enumerate(order):
        near = [order[k] for k in (at - 1, at + 1) if 0 <= k < len(order) and host and order[k][0] == host]
        best = max(near, key=lambda p: extraction._alike(p[1], path), default=None)
        plain.append((i, extraction.main_text(extraction.blocks(text), best and extraction.blocks(best[4]))))
    assert (404, "Only 4/4") in plain and (-1, "No address") in plain and (-1, "2") in plain
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    try:
        for parts in (1, 2, 7, 64):
            spark.conf.set(setting, parts)
            assert sorted((r.page_id or -1, r.text) for r in extraction.extract(table).collect()) == sorted(plain)
    finally:
        spark.conf.set(setting, before)


def test_a_teaser_is_not_the_text():
    page, beside = (extraction.blocks(f"<p>Top</p><article>Teaser {n}</article><div>{'The text of page ' * 9}{n}</div><p>End") for n in (1, 2))
    text = "The text of page " * 9 + "1"
    assert extraction.main_text(page, beside) == f"Teaser 1\n{text}"
    assert extraction.main_text(page, page) == "Teaser 1"
    whole = extraction.blocks(f"<p>Top</p><main>{text}</main><p>End")
    assert extraction.main_text(whole, beside) == extraction.main_text(whole, None) == text


WORDS = " ".join(f"word{i}" for i in range(60))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f'<div class="layout with-sidebar"><article><p>{WORDS}</p></article></div>', WORDS),
        (f'<div class="page no-comments"><p>{WORDS}</p><p>more</p></div>', f"{WORDS}\nmore"),
        (f'<article class="post share-enabled"><p>{WORDS}</p></article>', WORDS),
        (f'<main><section class="notice-board"><p>{WORDS}</p></section></main>', WORDS),
        ("<p title=it's>Hello</p><p>don't</p>", "Hello\ndon't"),
        (f"<!--><p>{WORDS}</p><!-- x -->", WORDS),
        (f"<!---><p>{WORDS}</p>", WORDS),
        ("<p>Let <math><mi>x</mi></math> be <svg><text>no</text></svg>a <button>press</button>number <iframe src=x></iframe>here</p>", "Let x be a number here"),
        (f"<form id=aspnet><article>{WORDS}</article></form>", WORDS),
        (f"<form><p>{WORDS}</p></form><p>tail</p>", f"{WORDS}\ntail"),
        (f'<article>{WORDS}</article><section id="comments"><article class="comment">{WORDS} {WORDS}</article></section>', WORDS),
        (f"<article>{WORDS}</article><aside><article>Another story</article></aside>", WORDS),
        (f'<article>{WORDS}<div class="promo">Buy</div><p>end</article>', f"{WORDS}\nend"),
        (f'<div class="site-footer">small</div><p>{WORDS}</p><div class="sidebar-left">small</div>', WORDS),
        (f'<p data-x="class=ad">{WORDS}</p>', WORDS),
        (f'<p class=ad>Buy<div>{WORDS}</div>', WORDS),
        (f'<ul><li class="ad">Buy<li>{WORDS}</ul>', WORDS),
        (f'<a href="x>y">{WORDS}</a> <x-own>z</x-own>', f"{WORDS} z"),
        (f"<article>short</article><div>{WORDS}</div>", "short"),
    ],
)
def test_markup_that_hides_articles(page, text):
    assert extraction.main_text(extraction.blocks(page), None) == text


def plain_difference(own, other):
    """Blocks of ``own`` that no longest common subsequence with ``other`` holds, by dynamic programming."""
    n, m = len(own), len(other)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if own[i] == other[j] else max(best[i + 1][j], best[i][j + 1])
    return n - best[0][0]


def test_pages_without_article_by_a_plain_version(spark):
    """Three templates, hosts of many pages, no article or main anywhere: differencing decides."""
    rng = random.Random(8)
    top = {"a": ["Logo", "Menu line"], "b": ["Welcome", "Login", "Archive"], "c": []}
    pages, own = [], {}
    for i in range(120):
        kind = rng.choice("abc")
        lines = [f"{rng.choice('xyz')} text {i} {j} of its own" for j in range(rng.randint(1, 6))]
        body = [*top[kind], *lines, *([f"Contact {kind}"] if kind != "c" else [])]
        pages.append((i, f"http://{kind}.org/{i:04d}", "".join(f"<div>{x}</div>" for x in body)))
        own[i] = (kind, body, lines)
    rows = {r.page_id: r.text.split("\n") for r in extraction.extract(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)).collect()}
    for i, (kind, body, lines) in own.items():
        beside = [j for j in own if own[j][0] == kind and j != i]
        near = min((j for j in (max((j for j in beside if j < i), default=None), min((j for j in beside if j > i), default=None)) if j is not None), key=lambda j: (-extraction._alike(f"/{i:04d}", f"/{j:04d}"), j))
        assert rows[i] == lines and len(rows[i]) == plain_difference(body, own[near][1])


def test_many_ranges_place_pages_alike(spark):
    pages = [(i % 97 or None, None if i % 11 == 0 else f"http://h{i % 5}.org/{i * 7919 % 1000}/é", f"<p>{i}</p>") for i in range(400)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    found = []
    try:
        for parts in (1, 90):
            spark.conf.set(setting, parts)
            found.append(sorted(map(str, extraction.extract(table).collect())))
    finally:
        spark.conf.set(setting, before)
    assert found[0] == found[1] and len(found[0]) == 400


def plain_mix(h):
    m = (1 << 64) - 1
    h ^= h >> 31
    h = h * 0xBF58476D1CE4E5B9 & m
    h ^= h >> 29
    h = h * 0x94D049BB133111EB & m
    return h ^ (h >> 32)


def plain_ngrams(text):
    """Each letter in lower case with its neighbours, blanks for what is no letter."""
    import regex

    chars = [(c.lower() if len(c.lower()) == 1 else c) if regex.match(r"\p{L}", c) else " " for c in text or ""]
    padded = [" ", *chars, " "]
    return ["".join(padded[i : i + 3]) for i in range(len(chars)) if padded[i + 1] != " "]


def test_languages_and_scores_by_a_plain_recount(spark, sf_dir, sf_docs):
    rows = sf_docs.select("doc_id", "text", "lang").collect()
    counts = collections.defaultdict(collections.Counter)
    for r in rows:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            counts[r.lang].update(plain_ngrams(r.text))
    languages = sorted(counts)
    rate = {k: {g: n / sum(counts[k].values()) for g, n in counts[k].items()} for k in languages}
    rate = {k: {g: x for g, x in v.items() if x >= language.LEAST_RATE} for k, v in rate.items()}
    most = collections.defaultdict(float)
    for v in rate.values():
        for g, x in v.items():
            most[g] = max(most[g], x)

    def places(gram):
        h = plain_mix(ord(gram[0]) << 42 | ord(gram[1]) << 21 | ord(gram[2]))
        step = plain_mix(h) | 1
        return [(h + i * step) % (1 << 64) % language.POSITIONS for i in range(language.HASHES)]

    filled = {k: {p for g, x in v.items() if x * language.WITHIN >= most[g] for p in places(g)} for k, v in rate.items()}
    false = {k: (len(p) / language.POSITIONS) ** language.HASHES for k, p in filled.items()}
    found = {r.doc_id: r for r in queries.op4_language_bitmask(spark, sf_dir).collect()}
    assert len(found) == len(rows) and len(languages) == 4
    for r in rows:
        grams = collections.Counter(plain_ngrams(r.text))
        n = sum(grams.values())
        corrected = []
        for k in languages:
            hits = sum(c for g, c in grams.items() if all(p in filled[k] for p in places(g)))
            corrected.append((hits - n * false[k]) / (1 - false[k]))
        best = max(range(4), key=lambda i: corrected[i]) if n else None
        got = found[r.doc_id]
        assert got.lang_pred == (languages[best] if n else "und")
        assert got.score == pytest.approx(min(1, max(0, corrected[best] / n)) if n else 0)


def test_teams_of_chunks_get_the_same_answers(spark, sf_docs, monkeypatch):
    docs = sf_docs.select("doc_id", "text").repartition(12).cache()  # a chunk or two each
    rows = [sorted(map(tuple, lm.score(docs, id_text_crc("doc_id") % 5 != 1).collect()))]
    monkeypatch.setattr(lm, "MOST_FAN", 3)
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 9_000)
    rows.append(sorted(map(tuple, lm.score(docs, id_text_crc("doc_id") % 5 != 1).collect())))
    assert len(rows[0]) == len(rows[1]) == docs.count()
    for a, b in zip(*rows, strict=True):
        assert a[:3] == b[:3] and a[5] == b[5] and a[3:5] == pytest.approx(b[3:5], rel=1e-9)
    stored = lm.chunks(docs.withColumns({"learns": F.lit(True), "held": F.lit(False)})).cache()
    asked = lm.answers(stored, 20).where("chunk >= 0").groupBy("chunk", "kind").count().collect()
    assert len(asked) >= 20 and all(r["count"] <= 3 for r in asked)
