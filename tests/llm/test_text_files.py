import zlib

import numpy as np
import public_tokenizers
import pytest
from samples import frame, odd
from tokenizers import Tokenizer

from tidemark.llm.token_files import NO_ID, read_token_files, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_files_hold_what_the_tokenizer_gives(spark, tmp_path, name):
    path = public_tokenizers.path(name)
    tokenizer = Tokenizer.from_file(path)
    hard = [
        (20, "It's  a\ttest,\n 12 é—ß\r\nx 'tis DON'T, (x), [y]. 3.5% ...!!! a_b"),
        (21, "ΣΑΣ σς İstanbul <|endoftext|> <|ENDOFTEXT|>, x nb\x1cfs\x0bvt é ́x"),
    ]
    docs = odd() + hard
    folder = f"file://{tmp_path}/{name}"
    manifest = write_token_files(frame(spark, docs), folder, path, end=1).orderBy("shard").collect()
    got = read_token_files(spark, folder, with_ids=True).collect()
    want = sorted(
        ((NO_ID if i is None else i), tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])) for i, t in docs
    )
    assert sorted((NO_ID if r.doc_id is None else r.doc_id, tuple(r.ids)) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    in_order = [NO_ID if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert in_order == sorted(in_order)
    flat = np.concatenate([np.fromfile(f"{tmp_path}/{name}/{m.shard}.ids", m.kind) for m in manifest])
    assert len(flat) == at and [m.base for m in manifest] == np.cumsum([0] + [m.tokens for m in manifest])[:-1].tolist()


def test_no_documents(spark, tmp_path):
    folder = f"{tmp_path}/none"
    assert write_token_files(frame(spark, []), folder, PATH).count() == 0
    assert read_token_files(spark, folder).count() == 0
