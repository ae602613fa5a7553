"""The contract queries against brute force on the smallest tables."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lotweave.llm import quality
from lotweave.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def result(spark):
    kept = {}

    def run(name):
        if name not in kept:
            kept[name] = [r.asDict() for r in QUERIES[name](spark, SF).collect()]
        return kept[name]

    return run


def test_quality_counts_and_perplexity(result, documents):
    rows = {r["doc_id"]: r for r in result("op5_quality_rules")}
    assert len(rows) == len(documents)
    grams = defaultdict(Counter)
    codes = {}
    for i, text, lang, _ in documents:
        codes[i] = [(c >> 12, c >> 6 & 63, c & 63) for c in quality.trigram_codes(text or "").tolist()]
        grams[lang].update(codes[i])
    models = {lang: brute.kneser_ney(g, quality.CLASSES) for lang, g in grams.items()}
    for i, text, lang, _ in documents:
        r = rows[i]
        measured = brute.base_measures(text)
        assert measured == tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        failed = measured[0] < 50 or 100 * measured[4] > 50 * measured[0]
        assert r["base_failed"] == failed and not (r["kept"] and failed)
        if i % 9 == 0 and codes[i]:
            assert abs(-brute.log_mean([models[lang](*g) for g in codes[i]]) - r["log_perplexity"]) < 2e-4


def test_packing_is_a_round_trip(result, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in result("op6_mixture_packing"):
        pieces[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append(r)
    for i, text, *_ in documents:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for r in sorted(pieces.pop(i), key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert not pieces
    total = Counter(r["source"] for r in result("op6_mixture_packing") for _ in range(r["length"]))
    whole = sum(total.values())
    sizes = []
    for rows in windows.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        sizes.append(at)
        own = Counter()
        for r in rows:
            own[r["source"]] += r["length"]
        assert all(abs(own[s] - at * total[s] / whole) <= 2 for s in total)
    assert max(sizes) <= 2048 and max(sizes) - min(sizes) <= 1 and 2048 * len(sizes) - whole < 2048


def test_jaccard_components(result, documents):
    expected = brute.components([(i, t) for i, t, *_ in documents], 3, 90)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in result("op7_jaccard_join")} == expected


def test_toxicity_is_learnt(spark):
    rows = QUERIES["op8_toxicity"](spark, SF.replace("0.001", "0.1")).collect()
    import duckdb

    toxic = dict(duckdb.sql("SELECT doc_id, toxic FROM '/root/testdata/sf0.1/labels.parquet' WHERE toxic IS NOT NULL").fetchall())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    seen = [(r.predicted, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    hit = sum(p and t for p, t in seen)
    assert hit >= 0.8 * sum(t for _, t in seen) and hit >= 0.9 * sum(p for p, _ in seen)


def test_suffix_dedup(result, documents):
    expected = brute.suffix_dedup([(i, t) for i, t, *_ in documents])
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in result("op9_suffix_dedup")}
    assert got == expected


def test_line_dedup(result, documents):
    expected = brute.line_repeats([(i, t) for i, t, *_ in documents])
    got = {(r["doc_id"], r["line"]): (r["first_doc"], r["first_line"], r["distance"]) for r in result("op10_line_dedup")}
    assert got == expected


def test_lm_score(result, documents, spark):
    from lotweave.llm import lmscore

    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    token, first, pair = (defaultdict(lambda: [0, 0]) for _ in range(3))
    steps = {}
    import pyarrow as pa

    from lotweave.llm import textkit as tk

    for i, text, *_ in documents:
        for piece in tk.slices(pa.array([text])):
            t, b, p, _ = lmscore.slots(piece)
            steps[i] = list(zip(t.tolist(), b.tolist(), p.tolist()))
        for t, b, p in steps[i]:
            for table, key in ((token, t), (first, b), (pair, p)):
                table[key][0] += i in good
                table[key][1] += 1
    totals = [sum(v[which] for v in token.values()) for which in (0, 1)]
    onces = [sum(v[which] for v in token.values() if v[1] == 1) for which in (0, 1)]
    for r in result("op1_lm_score"):
        own = steps[r["doc_id"]]
        assert r["n_tokens"] == len(own)
        mine = [Counter(s[k] for s in own) for k in range(3)]
        listed = r["doc_id"] in good
        rest = [totals[0] - len(own) * listed, totals[1] - len(own)]
        own_once = sum(token[t][1] == 1 for t, _, _ in own)
        once, matched = [onces[0] - own_once * listed, onces[1] - own_once], rest[0] / rest[1]
        for which, name in enumerate(("target_loss", "background_loss")):
            part = matched if which else 1
            rate = matched if which else (once[0] + lmscore.SMOOTH) / (once[1] + lmscore.SMOOTH / matched)
            left = lambda table, k, key: table[key][which] - mine[k][key] * (listed or which)
            smooth = lambda t: rate if token[t][1] == mine[0][t] else part * left(token, 0, t) + lmscore.SMOOTH
            uni = lambda t: smooth(t) / (part * rest[which] + lmscore.SMOOTH * 2**lmscore.UNI)
            seen = lambda p: left(pair, 2, p) * (1 - (1 - part) ** left(pair, 2, p))
            losses = [
                -np.log(lmscore.MIX * min(seen(p) / max(left(first, 1, b), 1), 1) + (1 - lmscore.MIX) * uni(t)) for t, b, p in own
            ]
            assert abs(np.mean(losses) - r[name]) < 1e-9


def test_decontamination_finds_every_leak(result, documents):
    import duckdb

    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    clean = lambda t: [w.lower().strip(".,!?:;|*#$%&\"'()") for w in (t or "").split()]
    expected = set()
    for i, text, *_ in documents:
        own = " ".join(w for w in clean(text) if w)
        expected |= {(i, item) for item, t in items if " ".join(w for w in clean(t)[1:-1] if w) in own}
    got = {(r["doc_id"], r["item_id"]) for r in result("op4_decontaminate")}
    assert expected <= got and len(got) <= len(expected) + 1


def test_html_text(result):
    import html
    import re

    import duckdb

    pages = duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()
    got = {r["page_id"]: r for r in result("op2_html_text")}
    assert len(got) == len(pages)
    for i, page in pages:
        article = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:h1|p)>", article)]
        assert got[i]["text"] == "\n".join(b for b in blocks if b) and got[i]["n_chars"] == len(got[i]["text"])
