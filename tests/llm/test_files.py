"""Token files and archives: exact round trips."""

import base64
import gzip
import hashlib
import random
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.plain import DOCS, corpus
from tidemark.llm import archives, queries_files, token_files
from tidemark.sources.scratch import scratch_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(queries_files.tokenizer_path())


def plain(rows, tokenizer):
    """Rows with one doc_id may stand in any order, so ids only are compared for these."""
    start, out = 0, []
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2]
        out.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize(("ids", "keep"), [(token_files.SHARD_IDS, True), (20_000, False)])
def test_token_files_equal_whole_texts(spark, tokenizer, monkeypatch, ids, keep):
    monkeypatch.setattr(token_files, "SHARD_IDS", ids)
    monkeypatch.setattr(token_files, "RECORD_IDS", ids // 4)
    rows = corpus(40) + [(None, "no id", None, None, None)]
    got = sorted(tuple(r) for r in queries_files.encoded(spark.createDataFrame(rows, DOCS), keep).collect() if r[0] is not None)
    want = sorted(t for t in plain(rows, tokenizer) if t[0] is not None)
    assert got == want
    assert queries_files.encoded(spark.createDataFrame([], DOCS)).count() == 0


@settings(max_examples=120, deadline=None)
@given(
    st.lists(
        st.text(
            st.one_of(
                st.characters(codec="utf-8"),
                st.sampled_from("aBé's 'LL 12.,!?<|endoftext|> \t\n\x85\xa0́ßİΣ"),
            ),
            max_size=40,
        ),
        max_size=6,
    )
)
def test_chunks_give_the_ids_of_whole_texts(tokenizer, texts):
    encoder = token_files.ChunkEncoder(tokenizer, True)
    ids, counts = encoder.encode(pa.array(texts, pa.string()))
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [i for w in want for i in w]
    assert counts.tolist() == [len(w) for w in want]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=50))
def test_codes_round_trip(ranks):
    control, data = token_files.encode_ranks(np.array(ranks, np.uint32))
    assert len(control) == -(-len(ranks) // 4)
    assert token_files.decode_ranks(control, data, len(ranks)).tolist() == ranks


PAGES = "page_id long, url string, html string"


def page_rows():
    draw = random.Random(4)
    rows = [
        (1, None, None),
        (2, "http://a b/\n\x00c", ""),
        (3, "", "é" * 1000 + "\r\n\r\nWARC/1.1\r\n\r\n\nfiledesc://x 1\n"),
        (4, "u", "x" * 300_000),
        (None, "u", "x"),
        (None, "v", "only here"),
    ]
    rows += [(100 + i, f"http://h/{i}", draw.choice("xyz") * draw.choice([1, 2])) for i in range(60)]
    return rows + [rows[-1], rows[3]]


def wanted(rows):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    out = []
    for page_id, _, html in rows:
        raw, low = (html or "").encode(), first.get(html or "")
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        again = low is not None and low != page_id
        out.append((page_id, len(raw), digest, "revisit" if again else "response", low if again else None))
    return Counter(out)


@pytest.mark.parametrize("size", [archives.ARCHIVE_BYTES, 500])
def test_archives_round_trip(spark, monkeypatch, size):
    monkeypatch.setattr(archives, "ARCHIVE_BYTES", size)
    path = scratch_path(spark, "test-archives")
    pages = spark.createDataFrame(page_rows(), PAGES).repartition(3)
    archives.write_arc(pages, f"{path}/arc", versions=(1, 2))
    archives.convert(spark, f"{path}/arc", f"{path}/warc")
    records = archives.read_warc(spark, f"{path}/warc").cache()
    got = records.select("page_id", "payload_bytes", "payload_digest", "warc_type", "refers_to")
    assert Counter(map(tuple, got.collect())) == wanted(page_rows())
    ids = {(r["page_id"], r["payload_digest"]): r["record_id"] for r in records.collect()}
    assert len(set(ids.values())) == len(ids)


def test_small_payloads_can_be_left_whole(spark):
    path = scratch_path(spark, "test-archives")
    archives.write_arc(spark.createDataFrame(page_rows(), PAGES), f"{path}/arc")
    archives.convert(spark, f"{path}/arc", f"{path}/warc", least=2)
    kinds = archives.read_warc(spark, f"{path}/warc").groupBy("payload_bytes", "warc_type").count()
    assert not [r for r in kinds.collect() if r["payload_bytes"] < 2 and r["warc_type"] == "revisit"]


def test_legacy_lines_of_both_versions():
    one = archives.arc_opening(1, "x", "19960101") + b"\n" + archives.arc_record(
        1, "http://a/", "1.2.3.4", "19960923142103", "text/html", b"HTTP/1.0 200 OK\r\n\r\nhi\n"
    )
    (fields, body), = archives.parse_arc(one + b"\n\n", "one")
    assert fields["Archive-date"] == "19960923142103" and body.endswith(b"hi\n")
    two = archives.arc_opening(2, "x", "19960101") + b"\n" + b"dns:a b 1.2.3.4 1996 text/dns 001 c - 7 f.arc 3\nabc"
    (fields, body), = archives.parse_arc(two, "two")
    assert (fields["URL"], fields["Offset"], body) == ("dns:a b", "7", b"abc")
    assert archives.warc_date("1996") == "1996-01-01T00:00:00Z"
    assert archives.warc_date("19960923142103") == "1996-09-23T14:21:03Z"


@pytest.mark.parametrize(
    "bad",
    [b"no header", b"http://a 1 2 3 5\nabc", b"filedesc://x 0 0 t 9\n7 0 x\nU L", b"http://a 1 2 t 3\nabc"],
)
def test_malformed_archives_are_errors(bad):
    with pytest.raises(ValueError):
        list(archives.parse_arc(bad, "bad"))


def test_no_pages(spark):
    path = scratch_path(spark, "test-archives")
    pages = spark.createDataFrame([], PAGES)
    archives.write_arc(pages, f"{path}/arc")
    archives.convert(spark, f"{path}/arc", f"{path}/warc")
    assert archives.read_warc(spark, f"{path}/warc").count() == 0


def test_archives_are_deflated_fast(spark):
    """At the writer's own level, half of the work was deflating."""
    path, words = scratch_path(spark, "test-archives"), random.Random(3)
    html = " ".join("".join(words.choices("abcdefgh", k=words.randint(2, 6))) for _ in range(30_000))
    archives.write_arc(spark.createDataFrame([(1, "u", html)], PAGES).coalesce(1), f"{path}/arc")
    (content,) = (bytes(r["content"]) for r in archives._read(spark, f"{path}/arc").collect())
    assert html.encode() in gzip.decompress(content)
    assert len(content) > 1.02 * len(gzip.compress(gzip.decompress(content), 6))


def test_a_name_is_looked_up_once(tokenizer, monkeypatch):
    looked, find = Counter(), token_files.Table.find
    monkeypatch.setattr(token_files.Table, "find", lambda self, names: looked.update(names) or find(self, names))
    texts = ["Hello hello x-1 naïve", None, "Hello don't", "<|endoftext|> Hello"]
    encoder = token_files.ChunkEncoder(tokenizer, True)
    ids, counts = encoder.encode(pa.array(texts, pa.string()))
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]
    # "hello" is a chunk and a part, so once each.
    assert looked["Hello"] == 1 and looked["hello"] == 2


@pytest.mark.parametrize("ids", [[], [1], [3, 65_535], [70_000, 1]])
def test_packed_ids_are_read_back(ids):
    assert token_files._unpack(token_files._pack(np.array(ids, np.uint32))).tolist() == ids


def test_a_new_chunk_of_known_parts_takes_no_call(tokenizer):
    """A match, a split and a look-up of each in Python were most of the query's time."""
    encoder, words = token_files.ChunkEncoder(tokenizer, True), [a + b for a in "abcdefgh" for b in "éklm"]
    encoder.encode(pa.array([" ".join(words) + " -"]))
    text, calls = " ".join(f"{a}-{b}" for a in words for b in words), Counter()
    sys.setprofile(lambda _, event, what: calls.update([event]))
    try:
        ids, _ = encoder.encode(pa.array([text]))
    finally:
        sys.setprofile(None)
    assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert calls.total() < len(words) ** 2
