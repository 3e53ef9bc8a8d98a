import sys
import unicodedata
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import plain

import corpus_pipeline
from quarry.llm import secret_scan


def rejected(text):
    text = text or ""
    n, chars, symbols, _, repeats, failed = plain.quality(text)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    letters = [c for c in text if unicodedata.category(c)[0] == "L"]
    capitals = [c for c in letters if unicodedata.category(c) == "Lu"]
    return (
        failed
        or symbols * 100 > chars * 5
        or (len(lines) >= 4 and (len(lines) - len(set(lines))) * 100 > len(lines) * 50)
        or not n * 2 <= chars <= n * 25
        or (len(letters) >= 40 and len(capitals) * 100 > len(letters) * 60)
    )


def masked(texts):
    """With the bounds that all candidates of these texts give."""
    found = {i: (b := secret_scan._base(t), secret_scan._candidates(t, b)) for i, t in texts.items()}
    least = secret_scan.bounds(Counter((of, step) for _, cs in found.values() for _, _, of, step in cs))
    out = {}
    for i, (base, candidates) in found.items():
        spans = sorted(base + [(s, 3, e) for s, e, of, step in candidates if of in least and step >= least[of]])
        text, at = "", 0
        for s, k, e in spans:
            if s >= at:
                text += texts[i][at:s] + f"[{secret_scan.KINDS[k]}]"
            at = max(at, e)
        out[i] = text + texts[i][at:]
    return out


def test_run_equals_the_plain_stages(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = [(i, t) for i, t in rows if not rejected(t)]
    keep = {r[0] for r in plain.exact_dedup(rows) if r[3]}
    rows = [(i, t) for i, t in rows if i in keep]
    ids = [i for i, _ in rows]
    heads = set(plain.components(ids, [plain.fingerprint(t) for _, t in rows]))
    texts = masked({i: t for i, t in rows if i in heads})
    encode = plain.tokenizer("byte_bpe_50k.json")
    want = {(i, k): x for i, t in texts.items() for k, x in enumerate(plain.cut([*encode(t), 0]))}
    got = corpus_pipeline.run(spark, sf).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)


def test_stages_keep_the_columns_and_take_empty_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs.limit(0), sf)
        assert out.count() == 0
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name


def test_clean_documents_stay(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1"), "doc_id").select("doc_id", "text", "lang", "source", "n_chars")
    long = [r["doc_id"] for r in docs.collect() if not plain.quality(r["text"])[5]]
    assert {r["doc_id"] for r in corpus_pipeline.quality(spark, docs, sf).collect()} >= set(long)
