import random

import numpy as np
import public_tokenizers
import pytest

from picsift.llm import tokencount
from picsift.llm.bpe import _codec

from helpers import empty_docs, odd_docs, odd_rows

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def codec():
    with open(PATH, "rb") as f:
        return _codec(f.read(), public_tokenizers.PATTERN)


@pytest.mark.parametrize("block,width", [(1, "<u2"), (3, "<u2"), (7, "<u4"), (1 << 20, "<u2")])
def test_flat_files_against_a_plain_split(spark, tmp_path, block, width):
    rng = random.Random(block)
    want = {}
    for k in range(6):
        counts = [rng.choice([0, 0, 1, 2, 5, 30]) for _ in range(rng.randint(0, 12))]
        tail = rng.choice([0, 0, 4]) if k else 3
        flat = [x for n in counts for x in [rng.randint(0, 900) for _ in range(n)] + [999]] + [1] * tail
        np.array(flat, dtype=width).tofile(f"{tmp_path}/f{k}.bin")
        want[f"f{k}.bin"] = [(n, True) for n in counts] + ([(tail, False)] if tail else [])
    blocks = tokencount.blocks_of_files(spark, str(tmp_path), width, block)
    got = {}
    for r in sorted(tokencount.documents(tokencount.scan(blocks, 999, width)).collect(), key=lambda r: (r.file, r.ordinal)):
        mine = got.setdefault(r.file.rsplit("/")[-1], [])
        assert r.ordinal == len(mine) and r.start == sum(n for n, _ in mine) + len(mine)
        mine.append((r.n_tokens, r.closed))
    assert got == {k: v for k, v in want.items() if v}


def test_registered_query_counts_what_the_encoder_gives(spark):
    rows = tokencount.op8_token_counts(spark, SF).collect()
    c = codec()
    want = {r.doc_id: len(c.encode(r.text or "")) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id: r.n_tokens for r in rows} == want and len(rows) == len(want)


def test_odd_rows_over_small_blocks(spark, tmp_path):
    c = codec()
    blocks = tokencount.write_tokens(odd_docs(spark, clashes=True).repartition(3), f"{tmp_path}/t", PATH, block=50)
    found = tokencount.documents(tokencount.scan(blocks)).collect()
    assert sorted(r.n_tokens for r in found) == sorted(len(c.encode(r[1] or "")) for r in odd_rows()) and all(r.closed for r in found)
    named = [x for r in blocks.select("doc_ids").collect() for x in r.doc_ids]
    assert sorted(map(str, named)) == sorted(str(r[0]) for r in odd_rows())
    none = tokencount.write_tokens(empty_docs(spark), f"{tmp_path}/e", PATH)
    assert tokencount.documents(tokencount.scan(none)).count() == 0


@pytest.mark.parametrize("last,separator,width", [(70000, 50256, "<u2"), (255, 65536, "<u2"), (50256, 50256, "<u2")])
def test_ids_that_would_wrap_or_separate_are_refused(spark, tmp_path, last, separator, width):
    import base64
    lines = [f"{base64.b64encode(bytes([i])).decode()} {i}" for i in range(256)] + [f"{base64.b64encode(b'ab').decode()} {max(last, 256)}"]
    (tmp_path / "v.tiktoken").write_text("\n".join(lines) + "\n")
    df = spark.createDataFrame([(1, "abab")], "doc_id long, text string")
    with pytest.raises(ValueError, match="separator"):
        tokencount.write_tokens(df, f"{tmp_path}/t", f"{tmp_path}/v.tiktoken", separator=separator, width=width)
    tokencount.write_tokens(df, f"{tmp_path}/w", f"{tmp_path}/v.tiktoken", separator=99999, width="<u4")
