import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from leafline.llm import packing


def test_patterns_hold_every_length_once():
    random.seed(1)
    for most in (8, 100, 2048):
        h = Counter(random.randint(1, most) for _ in range(3000))
        got = packing.patterns(dict(h), most)
        used = Counter()
        for count, lengths in got:
            assert count > 0 and sum(lengths) <= most
            for n in lengths:
                used[n] += count
        assert used == h


def test_shortest_pattern_takes_the_next_length():
    assert sorted(packing.patterns({7: 1, 5: 1, 3: 1, 2: 1}, 10)) == [(1, (5, 3)), (1, (7, 2))]


def check(spark, docs, most):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path("byte_bpe_50k.json"))
    df = spark.createDataFrame(docs, "doc_id long, text string, sequence_id string, length int")
    got = packing.pack(df, most).collect()
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    want = Counter()
    for doc_id, text, *_ in docs:
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for at in range(0, len(ids), most):
            want[(doc_id, at, len(ids[at : at + most]), crc32(ids[at : at + most].tobytes()), len(ids))] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= most
    assert sorted(seqs) == list(range(len(seqs)))


def test_pack(spark):
    random.seed(2)
    docs = [(n, " ".join(random.choices(["alpha", "beta", "gamma,", "ß", "\n"], k=random.randint(0, 90))), "x", 1) for n in range(200)]
    docs += [(200, None, None, None), (201, "", "x", 1), (None, "no id", "x", 1), (3, docs[3][1], "x", 1), (300, "long " * 5000, "x", 1), (301, "a<|endoftext|> b", "x", 1)] + [(400 + n, "same text again", "x", 1) for n in range(100)]
    check(spark, docs, 64)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_little_padding(spark):
    random.seed(3)
    h = Counter(min(2048, int(random.lognormvariate(5.5, 1))) + 1 for _ in range(20000))
    h = {k: v for k, v in h.items() if k <= 2048}
    got = packing.patterns(h)
    assert sum(c for c, _ in got) * 2048 < 1.02 * sum(k * v for k, v in h.items())


@pytest.mark.parametrize("text", ["plain words", "Ünïcode  spaces\t\n", "<|endoftext|>", "1234567 !!! 's", "ab" * 3000])
def test_encoder_agrees_with_the_tokenizer(text):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    assert packing.encoder()(text).tolist() == Tokenizer.from_file(path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
