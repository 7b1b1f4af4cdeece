"""The pipeline's stages on small tables."""

import hashlib

import corpus_pipeline
import public_tokenizers
from llm_rows import ODD

from claimlens.llm import bpe, queries

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_keep_columns_and_decide(work, docs):
    prose = [(20 + i, " ".join(f"w{i}x{j}" for j in range(40)) + "\nfooter line of many sites", f"s{i % 12}") for i in range(36)]
    copies = [(100 + i, prose[0][1], "s1") for i in range(5)]
    table = docs([(d, t) for d, t in ODD] + prose + copies).select(*COLUMNS)
    out = table
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = work.createDataFrame(stage(work, out, SF).collect(), table.schema)
        assert out.columns == COLUMNS, name
        seen.append(out.collect())
    quality, lines, classes, mix = seen
    assert {r.doc_id for r in quality} >= {d for d, *_ in prose}
    assert sum("footer" in r.text for r in lines) == 1
    assert all(r.n_chars == len(r.text) for r in lines if "footer" not in r.text and r.doc_id in range(20, 56))
    assert {r.doc_id for r in classes} & set(range(100, 105)) == set()
    assert {r.doc_id for r in classes} >= {d for d, *_ in prose}
    assert {r.doc_id for r in mix} <= {r.doc_id for r in classes}


def test_run_gives_ids_of_kept_texts(work):
    got = corpus_pipeline.run(work, SF).collect()
    assert got
    engine = bpe.encoder(queries.vocabulary(), public_tokenizers.PATTERN)
    for r in got[:50]:
        assert r.n_tokens == len(r.ids)
        assert hashlib.sha256(engine.decode(r.ids).tobytes()).hexdigest() == r.decoded_sha256
