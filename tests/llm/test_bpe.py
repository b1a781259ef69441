import hashlib
import os
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from audix.llm import bpe
from tests.llm.helpers import DOCS, frame

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
CODER = bpe.coder(RANKS, public_tokenizers.PATTERN)
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODER.ranks, special_tokens={})


def texts():
    rnd = random.Random(1)
    kinds = [lambda: rnd.randint(32, 126), lambda: rnd.randint(9, 13), lambda: 32, lambda: rnd.randint(0x80, 0x2fff),
             lambda: rnd.randint(0x10000, 0x1ffff)]
    odd = ["", " ", "  a", "a  b\n\n c", "\x1c\x1d \x85\xa0x y\u3000", "it's we'll I'VE", "ab" * 900, "é" * 200,
           "日本語" * 60, "<|endoftext|>", "٣٤٥ ½²", "\ufeff a\x00b"]
    return odd + ["".join(chr(rnd.choice(kinds)()) for _ in range(rnd.randint(1, 300))) for _ in range(200)]


@pytest.mark.parametrize("stretch, wide", [(1 << 18, 64), (7, 64), (1 << 18, 8)])
def test_ids_are_those_of_the_rank_file(monkeypatch, stretch, wide):
    monkeypatch.setattr(bpe, "STRETCH", stretch)
    monkeypatch.setattr(bpe, "WIDE", wide)
    coder = bpe.SegmentBPE(RANKS, public_tokenizers.PATTERN)
    for text, packed in zip(texts(), coder.encode(texts())):
        assert np.frombuffer(packed, "<u4").tolist() == REFERENCE.encode_ordinary(text)
        assert coder.decode(packed) == text.encode()


def test_remembered_matches_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    monkeypatch.setattr(bpe, "TOGETHER", 50)
    coder = bpe.SegmentBPE(RANKS, public_tokenizers.PATTERN)
    got = coder.encode(texts())
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [REFERENCE.encode_ordinary(t) for t in texts()]


def test_round_trip_rows(spark):
    got = sorted(map(tuple, bpe.round_trip(frame(spark), RANKS, public_tokenizers.PATTERN).collect()), key=str)
    want = []
    for key, text in DOCS:
        ids = REFERENCE.encode_ordinary(text or "")
        want.append((key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.round_trip(frame(spark, []), RANKS, public_tokenizers.PATTERN).collect() == []


def test_ids_and_bytes_as_tables(spark):
    ids = bpe.encode_texts(frame(spark), RANKS, public_tokenizers.PATTERN)
    back = bpe.decode_ids(ids, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted((t or "").encode() for _, t in DOCS)


#: Runs a task's function in a process of its own over batches made as they are asked for, then tells the MB that Arrow's pool
#: holds without use.
IDLE = r"""
import random, re, sys
import pyarrow as pa
from pathlib import Path
from audix.llm import bpe, ngram_join
import public_tokenizers

class Docs:  # hands out the function that Spark would run
    schema = {"doc_id": type("Field", (), {"dataType": type("Type", (), {"simpleString": staticmethod(lambda: "bigint")})})}
    select = lambda self, *columns: self
    mapInArrow = lambda self, run, schema: run

def anon():
    return int(re.search(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024

text = "the words of a long text " * 120
def batches(before):  # the text comes after so many other columns
    for _ in range(3):
        yield pa.RecordBatch.from_arrays([*(pa.array([0] * 5_000) for _ in range(before)), pa.array([text] * 5_000)],
                                         [str(i) for i in range(before + 1)])

bpe.F.col = lambda name: type("Column", (), {"alias": lambda self, name: self})()
run = {"bpe": (bpe.encode_texts(Docs(), bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN, decode=True), 1),
       "shingles": (ngram_join._describe, 3)}[sys.argv[1]]
rows = sum(b.num_rows for b in run[0](batches(run[1])))
held = anon()
pa.default_memory_pool().release_unused()
print(rows, held - anon())
"""


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory is read from /proc")
@pytest.mark.parametrize("task", ["bpe", "shingles"])
def test_an_idle_worker_gives_back_the_memory_of_its_batches(task):
    root = str(Path(__file__).parents[2])
    said = subprocess.run([sys.executable, "-c", IDLE, task], cwd=root, env=os.environ | {"PYTHONPATH": root}, capture_output=True,
                          text=True, check=True).stdout.split()
    assert int(said[-2]) == 15_000
    assert float(said[-1]) < 15
