"""The pipeline's stages, each against a plain version over what the stage before handed on."""

import statistics
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from lotweave.llm import quality
from tests.llm import brute
from tests.llm.conftest import SF


def _quality(docs):
    grams, codes = defaultdict(Counter), {}
    for i, (text, lang, *_) in docs.items():
        codes[i] = [(c >> 12, c >> 6 & 63, c & 63) for c in quality.trigram_codes(text or "").tolist()]
        grams[lang].update(codes[i])
    models = {lang: brute.kneser_ney(g, quality.CLASSES) for lang, g in grams.items()}
    loss, stay = {}, set()
    for i, (text, lang, *_) in docs.items():
        loss[i] = -brute.log_mean([models[lang](*g) for g in codes[i]]) if codes[i] else None
    for lang in grams:
        measured = {i: brute.base_measures(docs[i][0]) for i in docs if docs[i][1] == lang}
        bins = [int(loss[i] * 1000) for i, m in measured.items() if m[0] >= 50]
        middle = statistics.median_low(bins)
        reach = max(8 * 1.4826 * statistics.median_low([abs(b - middle) for b in bins]) / 1000, 0.35)
        centre = (middle + 0.5) / 1000
        stay |= {i for i, m in measured.items() if m[0] >= 50 and 2 * m[4] <= m[0] and abs(loss[i] - centre) <= reach}
    return stay


def test_every_stage(spark, tmp_path):
    held = {}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        held[name], docs = docs, spark.read.parquet(str(tmp_path / name))
        held[name] = ({r.doc_id: (r.text, r.lang, r.source, r.n_chars) for r in held[name].collect()}, docs.collect())

    before, after = held["quality_rules"]
    assert {r.doc_id for r in after} == _quality(before)
    assert all(before[r.doc_id][0] == r.text for r in after)

    before, after = held["line_dedup"]
    gone = brute.line_repeats([(i, d[0]) for i, d in before.items()])
    expected = {}
    for i, d in before.items():
        text = "\n".join(x for k, x in enumerate((d[0] or "").split("\n")) if (i, k) not in gone)
        if brute.words(text):
            expected[i] = (text, len(text))
    assert {r.doc_id: (r.text, r.n_chars) for r in after} == expected

    before, after = held["jaccard_join"]
    groups = brute.components([(i, d[0]) for i, d in before.items()], 5, 80)
    assert {r.doc_id for r in after} == {c for _, c in groups.values()}

    before, after = held["decontamination"]
    clean = lambda t: " ".join(w for w in (x.lower().strip(".,!?:;|*#$%&\"'()") for x in (t or "").split()) if w)
    items = [" ".join(clean(t).split()[1:-1]) for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    assert {r.doc_id for r in after} == {i for i, d in before.items() if not any(t in clean(d[0]) for t in items)}

    before, after = held["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    for r in after:
        pieces[r.doc_id].append(r)
    for i, d in before.items():
        ids = np.array([*tokenizer.encode(d[0] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        own = sorted(pieces[i], key=lambda r: r.start)
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1]] and own[-1].start + own[-1].length == len(ids)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in own)
    assert corpus_pipeline.run(spark, SF).count() == len(after)
