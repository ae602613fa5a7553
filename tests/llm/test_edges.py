"""Nulls, empty and very long texts, ties, repeated rows, empty tables and further columns."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lotweave.llm import decontaminate, htmltext, jaccard, linededup, lmscore, packing, quality, suffixdedup, toxicity, urlrules
from lotweave.llm import textkit as tk
from lotweave.llm.queries import vocabulary
from tests.llm import brute

BENCH = "item_id long, text string"


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, "same line that is long enough to be compared here"), (2, None), (3, ""), (4, "one two"), (1, "lorem ipsum dolor")]
    return spark.createDataFrame(rows, BENCH)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1), (3, 1, 0), (6, 0, 1)], "doc_id long, quality int, toxic int")


def test_lm_score(odd, none, labels):
    good = labels.where("quality = 1")
    rows = lmscore.score(odd, good).collect()
    assert len(rows) == odd.count() and all((r.difference is None) == (r.n_tokens == 0) for r in rows)
    assert lmscore.score(none, good).count() == 0
    assert all(r.difference in (None, 0) for r in lmscore.score(odd, good.where("false")).collect())
    clash = odd.withColumnRenamed("doc_id", "_marked").withColumn("records", odd.n)
    with_key = {(r[0], r.n_tokens, r.difference) for r in lmscore.score(clash, good.select(good.doc_id.alias("_marked")), "_marked").collect()}
    assert with_key == {(r.doc_id, r.n_tokens, r.difference) for r in rows}


def test_quality(odd, none):
    rows = quality.judge(odd).collect()
    assert len(rows) == odd.count() and not any(r.kept and r.base_failed for r in rows)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.base_measures(r.text)
    assert quality.kept_documents(odd).columns == odd.columns
    assert quality.judge(none).count() == 0


def test_toxicity(odd, none, labels):
    rows = toxicity.score(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(none, labels).count() == 0
    assert {r.predicted for r in toxicity.score(odd, labels.where("false")).collect()} == {0}


def test_toxicity_learns_from_every_label(spark):
    """The toxic documents are those whose ids have the highest hashes, behind more than 16,384 others."""
    ids = spark.range(30_000).where(~toxicity.held_out(F.col("id"))).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("h"))
    last = [r.doc_id for r in ids.orderBy("h").collect()][16_384:]
    assert len(last) > 1000
    toxic = F.col("doc_id").isin(last[::2])
    text = F.when(toxic, "plain vile words").otherwise("plain kind words")
    docs = spark.range(30_000).select(F.col("id").alias("doc_id")).select("doc_id", text.alias("text"))
    rows = toxicity.score(docs, docs.select("doc_id", toxic.cast("int").alias("toxic"))).collect()
    assert {r.doc_id for r in rows if r.predicted} == set(last[::2])


def test_places_of_keys():
    """Keys that share a slot are all found, and others are not."""
    keys = np.random.default_rng(3).integers(0, 1 << 63, 5000).astype(np.uint64)
    places = tk.Places(keys)
    assert places.find(keys).tolist() == list(range(5000)) and (places.find(keys + np.uint64(1)) == -1).all()
    assert tk.Places(keys[:0]).find(keys).max() == -1


def test_packing(odd, none):
    rows = packing.pack(odd, **vocabulary()).collect()
    assert len({r.doc_id for r in rows}) == len({r.doc_id for r in odd.select("doc_id").collect()})
    assert sum(r.length for r in rows if r.doc_id == 0) == 1
    assert packing.pack(none, **vocabulary()).count() == 0


@pytest.mark.parametrize("text", ["<|endoftext|> twice <|endoftext|>", "tab\tand  spaces \n\n", "don't 1234.5 ☃ é   x", "İstanbul ﬀ 你好"])
def test_both_vocabulary_files_agree(text):
    v = vocabulary()
    assert packing.encode(text, **v).tolist() == packing.encode(text, v["vocabulary"]).tolist()


def test_jaccard(odd, none):
    single = odd.where("doc_id IS NOT NULL AND doc_id <> 5")
    expected = brute.components([(r.doc_id, r.text) for r in single.collect()], 3, 90)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(single).collect()} == expected
    assert jaccard.join(odd).count() == odd.count()
    assert jaccard.join(none).count() == 0
    stay = jaccard.one_of_each(odd)
    assert stay.columns == odd.columns and stay.where("doc_id IS NULL").count() == 1 and stay.where("doc_id = 10").count() == 0


def test_jaccard_near_copies(spark):
    import random

    random.seed(3)
    vocabulary_ = [f"w{k}" for k in range(500)]
    texts = [[random.choice(vocabulary_) for _ in range(random.choice([5, 12, 40, 160, 400]))] for _ in range(25)]
    rows = []
    for t in texts:
        for _ in range(12):
            copy = list(t)
            for _ in range(random.randint(0, max(1, len(t) // 40))):
                copy[random.randrange(len(copy))] = random.choice(vocabulary_)
            rows.append((len(rows), " ".join(copy)))
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"))
    expected = brute.components(rows, 3, 90)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == expected
    assert len({c for _, c in expected.values()}) > 60  # some copies link and some do not


def test_jaccard_cut_tiles(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 4)
    test_jaccard_near_copies(spark)


def test_suffix_dedup(odd, none):
    single = odd.where("doc_id IS NOT NULL AND doc_id <> 5 AND length(text) < 200000")
    rows = {(r.doc_id, r.text) for r in single.collect()}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixdedup.dedup(single).collect()}
    assert got == brute.suffix_dedup(rows)
    assert suffixdedup.dedup(odd).count() == odd.count()
    assert suffixdedup.dedup(none).count() == 0


def test_suffix_dedup_repeated_ids(spark):
    """Every row of an id takes part: it may lose bytes to smaller ids and cover those of larger ones, never its own id's."""
    p, other, third = ("".join(chr(97 + (i * i * k + i // 7) % 26) for i in range(120)) for k in (3, 5, 7))
    rows = [(1, p), (2, p), (2, p + other), (2, p + other), (3, other), (3, third + other), (3, None), (4, third), (2, third)]
    data = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixdedup.dedup(data).collect())
    want = []
    for k, (i, text) in enumerate(rows):
        lower = [(j, t) for j, t in rows if j < i]
        want.append((i, *brute.suffix_dedup([*((n, t) for n, (_, t) in enumerate(lower)), (10**6 + k, text)])[10**6 + k]))
    assert got == sorted(want)


def test_suffix_dedup_hot_and_long(spark, monkeypatch):
    import random

    random.seed(5)
    letters = lambda n: "".join(random.choice("abcdefgh ") for _ in range(n))
    shared = [letters(n) for n in (30, 49, 50, 51, 90, 400)]
    rows = [(i, "".join(letters(random.randint(0, 60)) + random.choice(shared) for _ in range(random.randint(0, 6)))) for i in range(80)]
    monkeypatch.setattr(suffixdedup, "PART", 200)
    data = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = brute.suffix_dedup(rows)
    for hot in (1024, 3):
        monkeypatch.setattr(suffixdedup, "HOT", hot)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixdedup.dedup(data).collect()}
        assert got == expected


def test_lm_score_tells_every_ngram_apart(spark, monkeypatch):
    """More words than the former tables had slots, in several chunks and ranges, against exact counts."""
    import math
    import random
    from collections import Counter

    random.seed(11)
    rows = [(i, " ".join([f"w{random.randrange(400_000)}" if random.random() < 0.6 else random.choice("abcde") for _ in range(400)])) for i in range(400)]
    monkeypatch.setattr(lmscore, "CHUNK", 100_000)
    monkeypatch.setattr(lmscore, "RECORDS", 20_000)
    good = {i for i, _ in rows if i % 3 == 0}
    got = lmscore.score(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i,) for i in good], "doc_id long"))
    steps = {i: list(zip(["", *t.split()], t.split())) for i, t in rows}
    size = len({w for s in steps.values() for _, w in s})
    assert size > 2**lmscore.UNI
    tables = []
    for docs in (good, set(steps)):
        pair = Counter(p for i in docs for p in steps[i])
        first, token = Counter(), Counter()
        for (b, w), n in pair.items():
            first[b] += n
            token[w] += n
        tables.append((pair, first, token))
    expected = {"target_loss": {}, "background_loss": {}}
    for i, own in steps.items():
        mine = Counter(own), Counter(b for b, _ in own), Counter(w for _, w in own)
        rest = [sum(t[2].values()) - len(own) * on for t, on in zip(tables, (i in good, True))]
        everywhere = tables[1][2]
        own_once = sum(everywhere[w] == 1 for _, w in own)
        once = [sum(t[2][w] for w, n in everywhere.items() if n == 1) - own_once * on for t, on in zip(tables, (i in good, True))]
        matched = rest[0] / rest[1]
        for which, name in enumerate(expected):
            part, on = (matched, 1) if which else (1, i in good)
            rate = matched if which else (once[0] + lmscore.SMOOTH) / (once[1] + lmscore.SMOOTH / matched)
            pair, first, token = ({k: t[k] - on * m[k] for k in m} for t, m in zip(tables[which], mine))
            base = part * rest[which] + lmscore.SMOOTH * size
            seen = lambda p: pair[p] / max(first[p[0]], 1) * (1 - (1 - part) ** pair[p])
            smooth = lambda w: rate if everywhere[w] == mine[2][w] else part * token[w] + lmscore.SMOOTH
            expected[name][i] = sum(-math.log(0.7 * seen(p) + 0.3 * smooth(p[1]) / base) for p in own) / len(own)
    found = got.collect()
    assert len(found) == len(rows)
    assert all(abs(r[name] - own[r.doc_id]) < 1e-9 for r in found for name, own in expected.items())


def test_lm_score_does_not_tell_who_is_listed(spark):
    """Half of the good documents on the list: the other half scores alike, and good and bad stay apart."""
    import numpy as np

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality IS NOT NULL").select("doc_id", "quality").distinct()
    got = lmscore.score(docs, labels.where("quality = 1 AND crc32(cast(doc_id AS string)) % 2 = 0"))
    rows = got.join(labels, "doc_id").where("difference IS NOT NULL").selectExpr("difference", "quality", "crc32(cast(doc_id AS string)) % 2 AS held").collect()
    value, good, held = (np.array([r[k] for r in rows], dtype=float) for k in range(3))
    means = [value[(good == 1) & (held == k)].mean() for k in (0, 1)]
    a, b = value[(held == 1) & (good == 1)], value[(held == 1) & (good == 0)]
    auc = (np.searchsorted(np.sort(b), a, "left") + np.searchsorted(np.sort(b), a, "right")).sum() / (2 * len(a) * len(b))
    assert abs(means[0] - means[1]) < 0.1
    assert 1 - auc > 0.89


def test_line_dedup(odd, none):
    single = odd.where("doc_id IS NOT NULL AND doc_id <> 5 AND length(text) < 200000").dropDuplicates(["doc_id"])
    got = {(r.doc_id, r.line): (r.first_doc, r.first_line, r.distance) for r in linededup.repeats(single).collect()}
    assert got == brute.line_repeats([(r.doc_id, r.text) for r in single.collect()])
    left = linededup.without_repeats(odd)
    assert left.columns == odd.columns and left.where("doc_id IN (9, 10)").count() == 0 and left.where("doc_id IS NULL").count() == 1
    assert linededup.repeats(none).count() == 0


def test_line_dedup_edits(spark):
    import random

    random.seed(7)
    line = lambda: "".join(random.choice("abcdefghij") for _ in range(random.randint(38, 60)))
    base = [line() for _ in range(40)]
    rows = []
    for i in range(60):
        own = []
        for _ in range(4):
            x = list(random.choice(base))
            for _ in range(random.randint(0, 4)):
                k = random.randrange(len(x))
                x[k : k + random.randint(0, 1)] = random.choice(["", "z", "é"])
            own.append("".join(x))
        rows.append((i, "\n".join(own)))
    got = linededup.repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    expected = brute.line_repeats(rows)
    assert {(r.doc_id, r.line): (r.first_doc, r.first_line, r.distance) for r in got} == expected
    assert any(d for *_, d in expected.values())


def test_line_dedup_any_order(spark):
    x, y = "a line of text that is compared with others of it", "a line of text that is compared with others of iz"
    for other in (5, 1):
        rows = [(10, x), (other, y), (3, "another line, long enough to be compared, comes first\n" + x), (8, x), (2, "z" * 50)]
        for given in (rows, rows[::-1], sorted(rows)):
            got = linededup.repeats(spark.createDataFrame(given, "doc_id long, text string").coalesce(1)).collect()
            assert {(r.doc_id, r.line): (r.first_doc, r.first_line, r.distance) for r in got} == brute.line_repeats(rows)


def test_banded_distance():
    import random

    random.seed(1)
    for limit in (1, 2, 4):
        a, b = [], []
        for _ in range(300):
            x = bytes(random.choice(b"abc") for _ in range(random.randint(8, 40)))
            y = bytearray(x)
            for _ in range(random.randint(0, limit + 2)):
                k = random.randrange(len(y))
                y[k : k + random.randint(0, 1)] = random.choice([b"", b"a", b"c"])
            a.append(x), b.append(bytes(y))
        assert linededup.banded_distance(a, b, limit).tolist() == [min(brute.distance(x, y), limit + 1) for x, y in zip(a, b)]


def test_decontamination(odd, none, bench):
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(odd, bench).collect()}
    assert {(8, 1), (9, 1), (10, 1), (7, 1)} <= got and not {i for _, i in got} & {2, 3, 4}
    assert decontaminate.contaminated(none, bench).count() == 0
    assert decontaminate.contaminated(odd, bench.where("false")).count() == 0
    assert decontaminate.clean_documents(odd, bench).columns == odd.columns


def test_decontamination_of_new_parameters(spark):
    item = "A train leaves Boston with 120 people and 45 kg of mail. How many of the 120 people stay when 30 leave in Albany?"
    docs = [
        (1, "We ask this. A train leaves Dallas with 80 people and 12 lb of mail. How many of the 80 people stay when 9 leave in Houston? Done."),
        (2, "We ask this. A train leaves Dallas with 80 people and 12 lb of mail. How many of the 81 people stay when 9 leave in Houston? Done."),
        (3, "A train leaves the old station with many people who read their mail and stay until they leave again in the evening."),
    ]
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], BENCH))
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(1, 7)]


def test_url_rules(spark):
    rules = [("com", "/", "allow"), ("b.com", "/x", "block"), ("b.com", "/x/y", "allow"), ("b.com", "/x/y", "block"), ("c.b.com", "", "block"), (None, "/", "block"), ("org", "/", None)]
    pages = [
        (1, "http://A.B.COM/x/y/z?q"), (2, "https://b.com/x#f"), (3, "ftp://cb.com"), (4, None), (5, "nothing"), (6, "http://q.c.b.com"),
        (7, "http://b.com?x"), (8, "http:///p"), (9, "http://b.com./x"), (1, "http://A.B.COM/x/y/z?q"), (None, "http://b.com/é"),
    ]

    def brute_force(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = rest
        for mark in "/?#":
            host = host.split(mark)[0]
        path = rest[len(host) :].split("?")[0].split("#")[0]
        host = host.translate(brute.LOWER)
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if h and v and (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, None, "allow"))
        return host, path, best[2], best[3]

    data = spark.createDataFrame(pages, "page_id long, url string").selectExpr("*", "1 AS host", "2 AS rule")
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = sorted((r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in urlrules.judge_urls(data, frame).collect() if r.rule)
    assert got == sorted((i or 0, *brute_force(u)) for i, u in pages if brute_force(u)[2])
    assert urlrules.judge_urls(data, frame).count() == len(pages)
    assert {r.verdict for r in urlrules.judge_urls(data, frame.where("false"), "block").collect()} == {"block"}
    assert urlrules.judge_urls(data.where("false"), frame).count() == 0


def test_url_rules_over_many_ranges(spark):
    import random

    random.seed(2)
    name = lambda: ".".join(random.choice("ab") for _ in range(random.randint(1, 4)))
    route = lambda: "".join(random.choice("/ab") for _ in range(random.randint(0, 5)))
    rules = list({(h, p): (h, p, random.choice(["allow", "block"])) for h, p in ((name(), "/" + route()) for _ in range(60))}.values())
    pages = [(i, f"http://{name()}/{route()}") for i in range(500)]
    best = {}
    for i, url in pages:
        host, _, path = url[7:].partition("/")
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and ("/" + path).startswith(p)]
        best[i] = max(fits, default=(0, 0, None, "allow"))[2:]
    data = spark.createDataFrame(pages, "page_id long, url string")
    got = urlrules.judge_urls(data, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert {r.page_id: (r.rule, r.verdict) for r in got} == best


def test_html(spark):
    menu = "<div>Welcome to our lovely site where all things are fine today</div>"
    rows = [(i, f"http://h.com/{i}", f"<body>{menu}<p>text {i} about a subject nobody else writes of {i}</p>", "x") for i in range(4)]
    page = "<nav>a</nav><article class='post'><h1>A&amp;B</h1><div class='ad'>buy<p>now</div><p>one<br>two &lt;p&gt;</p><aside>s</aside><section id=comments><p>me</p></section>"
    rows += [(5, None, page, "y"), (6, "http://h.com", None, "z"), (6, "http://h.com", "", "z"), (None, "http://h.com/q", page, None)]
    got = htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    assert texts[2] == "text 2 about a subject nobody else writes of 2" and texts[6] == ""
    assert texts[5] == "A&B\none two <p>" == texts[None]
    none = spark.createDataFrame(rows, "page_id long, url string, html string, text string").where("false")
    assert htmltext.extract(none).count() == 0


def test_pipeline_stages(spark, odd, none):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert out.columns == docs.columns
            assert out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= 0


def test_stages_keep_values_of_clashing_columns(spark, documents):
    names = ["kept", "low", "high", "model", "n_words", "base_failed", "lines", "_lines", "_old", "_others", "log_perplexity"]
    rows = [(i, t, lang, *[f"{n} {i}" for n in names]) for i, t, lang, _ in documents]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"{n} string" for n in names))
    plain = {r.doc_id: r.text for r in linededup.without_repeats(docs.select("doc_id", "text", "lang")).collect()}
    for out in (quality.kept_documents(docs), linededup.without_repeats(docs)):
        assert out.schema == docs.schema
        got = out.collect()
        assert got and all(r[n] == f"{n} {r.doc_id}" for r in got for n in names)
    assert {r.doc_id: r.text for r in got} == plain


def test_short_lines_repeat_exactly(spark, monkeypatch):
    """Equal lines go whatever their length if they hold a word; near ones need ``min_bytes``; common lines are found by broadcast."""
    rows = [(i, f"Les.\n\n--\nChapter {i}\n \nown line of document {i}") for i in range(40)] + [(50, None), (51, "Les."), (None, "Les.")]
    data = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for common, many in ((1024, 1 << 16), (5, 1 << 16), (5, 0)):
        monkeypatch.setattr(linededup, "COMMON", common)
        monkeypatch.setattr(linededup, "COMMON_LINES", many)
        got = {(r.doc_id, r.line): (r.first_doc, r.first_line, r.distance) for r in linededup.repeats(data).collect()}
        assert got == {**{(i, k): (0, k, 0) for i in range(1, 40) for k in (0, 2)}, (51, 0): (0, 0, 0)}


def test_jaccard_large_classes(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, text) for i in range(30, 60)] + [(7, text + " more"), (8, "a b c d"), (9, "a b c d"), (10, ""), (None, text), (11, None)]
    data = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = None
    for large, classes in ((1024, 1 << 16), (5, 1 << 16), (5, -1)):
        monkeypatch.setattr(jaccard, "LARGE", large)
        monkeypatch.setattr(jaccard, "LARGE_CLASSES", classes)
        got = sorted(map(str, jaccard.join(data).collect()))
        want = want or got
        assert got == want
    by_id = {r.doc_id: r.component_id for r in jaccard.join(data).collect()}
    assert all(by_id[i] == 7 for i in range(30, 60)) and by_id[9] == 8 and by_id[10] == 10 and by_id[None] == 7


def test_spellings_reach_the_end_of_long_words():
    """Words that part after the tenth character are told apart."""
    data = pa.array(["Donaudampfschiff", "Donaudampfkessel", "Donaudampf"])
    (piece,) = tk.slices(data)
    step, before, row, _ = toxicity.spelling_steps(piece)
    own = [set(step[row == i].tolist()) for i in range(3)]
    assert len(own[0] - own[1]) == len(own[1] - own[0]) == 1 and len(own[0] & own[1]) == 10
    assert len(own[0]) == len(own[1]) == len(own[2]) == 11
    assert len(set(before[(row == 0) & np.isin(step, list(own[0] - own[1]))].tolist())) == 1


def test_every_language_has_a_model_and_a_band(spark):
    """More languages than a task counts at a time, and null: none shares another's counts."""
    names = [None, *(f"x{i}" for i in range(quality.HELD + 6))]
    rows = [(i, f"{'abcdefg'[i % 7]}{i} " * 60, names[i % len(names)]) for i in range(2 * len(names))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    counted = {r.lang: r.n for r in quality.count_trigrams(docs).groupBy("lang").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    assert counted == {name: sum(len(t) + 1 for _, t, lang in rows if lang == name) for name in names}
    judged = quality.judge(docs).select("lang", "model", "low", "high").distinct().collect()
    assert len({r.model for r in judged}) == len(judged) == len(names) and all(r.low < r.high for r in judged)


def _read_back(codes):
    symbols, out, i = (codes & 63).tolist()[:-1], [], 0
    while i < len(symbols):
        first, rest = symbols[i], symbols[i + 1 : i + 4]
        if first < quality.PAIRS:
            out.append(quality.PLAIN[first])
            i += 1
        elif first < quality.LONG:
            out.append(chr(quality.BLOCKS[first - quality.PAIRS] << 6 | rest[0]))
            i += 2
        else:
            out.append(chr(first - quality.LONG << 18 | rest[0] << 12 | rest[1] << 6 | rest[2]))
            i += 4
    return "".join(out)


def test_every_character_is_spelled():
    """No two characters share a spelling: each text can be read back from its trigrams."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    random.Random(5).shuffle(points)
    for text in ("".join(map(chr, points)), "A", "é\n", "“Ж”", "中文 \U0001f600x"):
        codes = quality.trigram_codes(text)
        assert codes.min() >= 0 and codes.max() < quality.CLASSES**3 and _read_back(codes) == text


def test_a_character_follows_the_two_before_it():
    """In every script the character before the last one tells histories apart, and a spelling goes on from its whole beginning."""
    for a, b in (("xyz", "wyz"), ("ABC", "DBC"), ("Жит", "Кит"), ("中国人", "美国人"), ("\U0001f600\U0001f601x", "\U0001f602\U0001f601x")):
        one, two = quality.trigram_codes(a)[:-1], quality.trigram_codes(b)[:-1]
        n = len(quality.trigram_codes(a[2])) - 1
        assert not set((one[-n:] >> 6).tolist()) & set((two[-n:] >> 6).tolist())
    # the same third and fourth symbol after different second ones
    one, two = quality.trigram_codes("一"), quality.trigram_codes(chr(ord("一") + (1 << 12)))
    assert (one[2:4] & 63).tolist() == (two[2:4] & 63).tolist() and not set((one[3:4] >> 6).tolist()) & set((two[3:4] >> 6).tolist())


def test_characters_apart_by_28_are_not_the_same(spark):
    """A text in letters its language does not use is told from one in those it does."""
    word = "".join(map(chr, range(0x430, 0x44C)))
    texts = [" ".join(word[k % 20 : k % 20 + 5] for k in range(i, i + 60)) for i in range(40)]
    other = "".join(chr(ord(c) + 28 * 7) if c != " " else c for c in texts[0])
    docs = spark.createDataFrame([*enumerate([*texts, other])], "doc_id long, text string").selectExpr("*", "'ru' AS lang")
    rows = {r.doc_id: r for r in quality.judge(docs, max_repeat_percent=100).collect()}
    assert rows[0].kept and not rows[40].base_failed and not rows[40].kept
    assert rows[40].log_perplexity > rows[0].log_perplexity + 0.5
