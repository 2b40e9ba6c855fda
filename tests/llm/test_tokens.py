import random
import uuid

import numpy as np
import pytest

from docquarry.llm import tokens
from docquarry.llm.common import shared_dir
from tests.llm import cases


def test_counts_equal_the_tokenizer(spark):
    docs = cases.frame(spark, ["<|endoftext|> is text here"])
    encoding = tokens.load_encoding()
    wanted = sorted(((r[0] is None, r[0] or 0, len(encoding.encode_ordinary(r[1] or ""))) for r in cases.rows(["<|endoftext|> is text here"])))
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"]) for r in tokens.count_tokens(docs).collect())
    assert got == wanted
    assert tokens.count_tokens(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("width", [2, 4])
def test_any_block_size_stitches(spark, width):
    directory = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    system, root = tokens._file_system(directory)
    system.create_dir(root)
    rng, wanted = random.Random(1), set()
    for name, ended in [("a.bin", True), ("b.bin", False), ("c.bin", True), ("d.bin", False)]:
        lengths = [] if name == "c.bin" else [rng.choice([0, 0, 1, 2, 5, 40]) for _ in range(30)] + [7]
        ids, at = [], 0
        for k, n in enumerate(lengths):
            ids += [rng.randrange(9) for _ in range(n)] + [9]
            wanted.add((name, k, at, n))
            at = len(ids)
        if not ended and ids:
            ids = ids[:-1]
        with system.open_output_stream(f"{root}/{name}") as out:
            out.write(np.array(ids, "<u4" if width == 4 else "<u2").tobytes())
    for block in [1, 2, 3, 7, 64, 1 << 20]:
        found = tokens.scan_token_files(spark, directory, separator=9, block_tokens=block, width=width)
        assert {(r["file"], r["nth"], r["first"], r["n_tokens"]) for r in found.collect()} == wanted
