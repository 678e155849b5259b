import hashlib
import random

import public_tokenizers
from tokenizers import Tokenizer

from colloquy.llm import bpe
from tests.llm.conftest import SF

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def expected(text):
    ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids
    decoded = TOKENIZER.decode(ids, skip_special_tokens=False)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(decoded)


def test_query_equals_the_tokenizer_on_whole_table(spark, queries):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
           for r in queries["op1_bpe"](spark, SF).collect()}
    assert got == {i: expected(t) for i, t in texts.items()}


def test_splitting_equals_the_tokenizer_on_odd_strings(docs_of):
    rng = random.Random(3)
    parts = ["a", "s", "re", "'", "'s", "'ll", " ", "  ", "\n", "\t", " ", "　", "\x1c", "\x85", "1", "²",
             "Ⅷ", "é", "中", "!", "-", "_", "<|endoftext|>", "<|endof", "text|>", "😀", "́", " '"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(400)]
    texts += [None, "", "x" * 50_000, " " * 3000 + "y", "a b " * 20_000]
    for common in (0, 50, bpe.COMMON):  # all rare, both, nearly all common
        got = {r["doc_id"]: r["ids"] for r in bpe.encode(docs_of(texts), PATH, common).collect()}
        for i, t in enumerate(texts):
            assert got[i] == TOKENIZER.encode(t or "", add_special_tokens=False).ids, (common, t)


def test_repeated_rows_null_ids_and_empty_tables(spark, docs_of):
    rows = [(1, "same words"), (1, "same words"), (1, "other"), (None, "qzx vbn"), (None, None)]
    got = sorted((str(r[0]), tuple(r[1])) for r in bpe.encode(docs_of(rows), PATH, 0).collect())
    assert got == sorted((str(i), tuple(TOKENIZER.encode(t or "").ids)) for i, t in rows)
    assert bpe.digests(docs_of([]), PATH).collect() == []
    assert bpe.encode(docs_of([]), PATH).collect() == []


def test_decode_round_trip_keeps_other_columns(docs_of):
    texts = ["héllo\n\nworld", "", "<|endoftext|> x", None]
    out = bpe.decode(bpe.encode(docs_of(texts), PATH), PATH)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert out.columns == ["doc_id", "ids", "text"]


def test_repeated_rows_keep_their_places_once(spark, docs_of):
    """Null ids with one text, and a repeated row, collect no more places than one row has."""
    rows = [(None, "zyzzyva qophs")] * 40 + [(5, "crwth zax")] * 40
    vocab = bpe.vocabulary(spark, PATH)
    got = bpe.rare_ids(docs_of(rows), vocab, bpe.common_words(docs_of([]), vocab)).collect()
    assert sorted(len(r["rare"]) for r in got) == [2, 2]
