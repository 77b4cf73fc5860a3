import zlib

import numpy as np
import pyarrow as pa
import pytest

from crossfade.llm import queries, token_files
from crossfade.llm.words import text_blocks

FILE = queries.tokenizer_file("byte_bpe_50k.json")
TEXTS = [
    "Plain words, with commas. And\nlines\n\n  indented   runs \t tabs ", "", None, " ", "  a", "a  ", "é à b 　c d　 e",
    "日本 語 text", "x<|endoftext|> y <|endoftext|>z", "don't  we'll 12 345,6 --- ...", "ünï\x1c a \x00 b\x85 c", "🙂 🙂🙂 ‍ a", "word " * 3000,
    "á b­ c", "\r\n \r\n a", "Ġ a Ġb",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


def test_runs_encode_like_whole_texts(tokenizer):
    runs = token_files._Runs(tokenizer)
    rng = np.random.default_rng(1)
    pieces = ["a", "word", " ", "  ", "\n", "\t", "é", "ß", ".", "'s", "12", " ", "　", "日", "🙂", "<|endoftext|>", "<", "\x1f", "Ж", "́"]
    texts = TEXTS + ["".join(rng.choice(pieces, 30)) for _ in range(2000)]
    got = []
    for _, data, offsets in text_blocks(pa.array(texts)):
        ids, sizes = token_files.encode_block(runs, data, offsets)
        got += [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
    assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_files_hold_all_rows_in_order(spark, folder, tokenizer):
    rows = [(i * 7 % 16, t, "x") for i, t in enumerate(TEXTS)] + [(3, "again", "y"), (3, "again", "y"), (None, "no id", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(5)
    token_files.write_tokens(df, FILE, folder)
    got = sorted(token_files.file_digests(spark, folder).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    expected = sorted(
        (-1 if i is None else i, len(e) + 1, zlib.crc32(np.array([*e, 0], "<u4").tobytes()))
        for i, t, _ in rows
        for e in [tokenizer.encode(t or "", add_special_tokens=False).ids]
    )
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == expected
    assert [r["start"] for r in got] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in got])])[:-1].tolist()
    assert token_files.read_tokens(spark, folder).where("doc_id = 5").count() == 1
    stored = {(r["doc_id"], r["start"]) for r in spark.read.orc(f"{folder}/index.orc").collect()}
    assert stored == {(r["doc_id"], r["start"]) for r in got}


def test_no_documents(spark):
    assert token_files.document_tokens(spark.createDataFrame([], "doc_id long, text string"), FILE).count() == 0
