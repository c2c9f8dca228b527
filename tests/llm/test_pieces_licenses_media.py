from __future__ import annotations

import gzip
import hashlib
import io
import random
import re
import struct
import zipfile
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sentrylake.llm import licenses, media, pieces, queries

EDGE = ["", " ", "   ", "a", "▁", " ▁ a", "\n\n\t", "\x00", "é" * 50, "안녕하세요 🎉🎉", "</s><s>[INST]", "a" * 6000, "ing " * 3000, " " * 5000, "x" + " " * 700 + "y", "​ ", "<0x41>", "the  the   the"]


@pytest.fixture(scope="module")
def model():
    return queries.piece_model(None)


@pytest.fixture(scope="module")
def both(model):
    import sentencepiece

    return pieces.PieceCodec(model), sentencepiece.SentencePieceProcessor(model_proto=model)


@pytest.mark.parametrize("text", EDGE)
def test_encoding_equals_the_library_on_edge_cases(both, text):
    own, library = both
    ids = own.encode(text)
    assert ids == library.encode(text)
    assert own.decode([*ids, own.eos]) == library.decode([*ids, own.eos])


def test_null_text_is_empty(both):
    assert both[0].encode(None) == []


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" ▁\n\tabcdefghijklmnop.,'!0123456789éßñ"), st.characters(exclude_categories=["Cs"])), max_size=80))
def test_encoding_equals_the_library(both, text):
    own, library = both
    assert own.encode(text) == library.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999)), max_size=30))
def test_decoding_equals_the_library(both, ids):
    assert both[0].decode(ids) == both[1].decode(ids)


@pytest.mark.parametrize("ids", [[197, 1, 131], [197, 131], [1, 197, 2, 131, 2], [2, 29871, 197, 1, 1, 131, 29871], [197, 0, 131, 2]])
def test_bytes_across_an_id_without_a_text_make_no_character(both, ids):
    assert both[0].decode(ids) == both[1].decode(ids)


def test_backtracking_is_needed_and_used(both):
    """Texts whose greedy longest match is not what merging gives."""
    own, _ = both
    r = random.Random(0)
    differs = 0
    for _ in range(500):
        word = "▁" + "".join(r.choice("theringsaondl") for _ in range(12))
        ids, at, greedy = own.backtrack(word), 0, []
        longest = {e - b: i for e, (b, i) in own.automaton.iter(word)}
        while at < len(word):
            greedy.append(longest[at])
            at += own.length[longest[at]]
        assert [own.name[i] for i in ids] == own.merged(word)
        assert ids == own.long(word)
        differs += ids != greedy
    assert differs > 100


def test_full_caches_change_nothing(both, model, monkeypatch):
    monkeypatch.setattr(pieces, "CACHED", 3)
    own = pieces.PieceCodec(model)
    text = "one two three four five six seven one two three"
    assert own.encode(text) == both[1].encode(text)


def test_query_over_documents(spark, sf_dir, both):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op1_sentencepiece(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = [*both[1].encode(docs[r["doc_id"]] or ""), 2]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(both[1].decode(ids).encode()).hexdigest()


# Licenses.
def plain_base(text):
    """Words, and places of the base phrases, the slow way."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = [(i, label) for phrase, label in licenses.BASE_PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), sorted(found)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["MIT", "License", "license.", "apache", "general", "Public-", "public", "GNU", "é", "mité", "\x7f", "~", "x1", "LICENSE\n", "ﬁ", "\x85", " "]), max_size=25), st.sampled_from([" ", "-", "", "\t", "é"]))
def test_base_phrases_equal_a_plain_search(parts, glue):
    text = glue.join(parts)
    n, hits = SCANNER.scan(text)
    assert (n, sorted((h.first, h.label) for h in hits if h.base)) == plain_base(text)


SCANNER = licenses.LicenseScanner()


def test_rules_are_many_and_ordered():
    assert len(SCANNER.rules) > 200
    assert [r.priority for r in SCANNER.rules] == sorted((r.priority for r in SCANNER.rules), reverse=True)


def spellings(parsed):
    """Texts that a parsed expression matches: each branch, and each repeated part at its fewest and once more."""
    out = [""]
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            ways = [chr(value)]
        elif name == "ANY":
            ways = ["x"]
        elif name == "IN":
            ways = [chr(v if str(k) == "LITERAL" else v[0]) for k, v in value]
        elif name == "BRANCH":
            ways = [t for b in value[1] for t in spellings(b)]
        elif name == "SUBPATTERN":
            ways = spellings(value[-1])
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, what = value
            ways = [t * n for n in {low, min(low + 1, high)} for t in spellings(what)]
        else:
            assert name in ("ASSERT_NOT", "AT"), name
            continue
        out = [a + b for a in out for b in ways]
    return out


def test_every_alternative_of_every_rule_is_found_alone():
    seen = 0
    for rule in SCANNER.rules:
        for text in spellings(re._parser.parse(rule.pattern.pattern)):
            text = " ".join(re.findall("[0-9a-z]+", text))
            if not rule.pattern.search(text):
                continue  # an optional bracket, which no joined words hold
            seen += 1
            hits = []
            for r in SCANNER.rules:
                for m in r.pattern.finditer(text):
                    if not r.base or f" {text} "[m.start()] == f" {text} "[m.end() + 1] == " ":
                        first = text[: m.start()].count(" ")
                        hits.append(licenses.Hit(r.label, r.priority, first, first + m[0].count(" ") + 1, r.base))
            assert any(h.label == rule.label for h in hits)
            assert SCANNER.scan(text)[1] == SCANNER.settle(hits), (rule.label, text)
    assert seen > 2 * len(SCANNER.rules) - 50
    for text, label in {"Zero-Clause BSD": "0bsd", "X Consortium": "mit-x11", "ASL 2.0": "apache-2", "PSF License Agreement": "python-2"}.items():
        assert label in labels(text)


def labels(text):
    return {h.label for h in SCANNER.scan(text)[1]}


def test_higher_rules_suppress_what_they_contain():
    assert labels("GNU General Public License version 3 or later") == {"gpl", "gpl-3-or-later"}
    assert labels("licensed under the Apache License, Version 2.0") >= {"apache", "apache-header", "apache-2"}
    assert labels("SPDX-License-Identifier: GPL-2.0-only") == {"spdx-tag"}
    assert labels("CC BY-SA 4.0") == {"cc-by-sa-4.0"}
    assert labels("permit licenses of a mitten") == set()


def test_containment_equals_a_plain_search():
    r = random.Random(1)
    for _ in range(300):
        hits = [licenses.Hit(f"l{i}", r.randint(1, 3), a := r.randint(0, 12), a + r.randint(1, 6), False) for i in range(r.randint(0, 10))]
        standing = []
        for h in sorted(hits, key=lambda h: (-h.priority, h.first - h.last, h.first, h.label)):
            if not any(s.first <= h.first and h.last <= s.last for s in standing):
                standing.append(h)
        assert SCANNER.settle(hits) == sorted(standing, key=lambda h: (h.first, h.last, h.label))


def test_license_edges(spark, sf_dir):
    assert SCANNER.scan(None) == SCANNER.scan("") == (0, [])
    n, hits = SCANNER.scan("mit license " * 20_000)
    assert n == 40_000 and sum(h.base for h in hits) == 20_000
    assert licenses.confidence(0, []) == 0.0 and 0 < licenses.confidence(n, hits) <= 1
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op10_licenses(spark, sf_dir).collect():
        n, found = plain_base(docs[r["doc_id"]])
        assert (r["n_words"], r["n_base"]) == (n, len(found))
        assert (r["first_word"], r["last_word"]) == ((found[0][0], found[-1][0]) if found else (None, None))
        assert r["base_labels"] == ",".join(sorted({x[1] for x in found})) and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))


# Media.
AUTOMATON = media.signature_automaton()


def png():
    chunk = lambda n, d: struct.pack(">I", len(d)) + n + d + struct.pack(">I", zlib.crc32(n + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0\0")) + chunk(b"IEND", b"")


def gif():
    return b"GIF89a" + struct.pack("<HHBBB", 1, 1, 0x80, 0, 0) + bytes(6) + b"," + struct.pack("<HHHHB", 0, 0, 1, 1, 0) + b"\x02\x02D\x01\x00;"


def jpeg():
    frame = b"\xff\xc0" + struct.pack(">HBHHB", 11, 8, 1, 1, 1) + b"\1\x11\0"
    return b"\xff\xd8" + b"\xff\xe0" + struct.pack(">H", 16) + b"JFIF\0" + bytes(9) + frame + b"\xff\xda" + struct.pack(">H", 8) + bytes(6) + b"\x12\xff\x00\x34\xff\xd9"


def zipped():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.txt", "hello")
    return out.getvalue()


def bmp():
    return b"BM" + struct.pack("<IHHI", 58, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, 1, 1, 1, 24, 0, 4, 0, 0, 0, 0) + bytes(4)


class Unseekable(io.RawIOBase):
    """Makes zipfile write sizes behind the entries."""

    def __init__(self):
        self.data = b""

    def writable(self):
        return True

    def write(self, data):
        self.data += bytes(data)
        return len(data)


def streamed_zip():
    out = Unseekable()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", "a" * 1000)
        z.writestr("b", "b")
    return out.data


_FTYP, _MOOV = struct.pack(">I", 16) + b"ftypisom\0\0\0\0", struct.pack(">I", 8) + b"moov"


@pytest.mark.parametrize("kind, whole, open_end", [
    ("application/zip", streamed_zip(), False),
    ("video/mp4", _FTYP + struct.pack(">I", 1) + b"mdat" + struct.pack(">Q", 20) + b"data" + _MOOV, False),
    ("video/mp4", _FTYP + _MOOV + struct.pack(">I", 0) + b"mdat" + b"data", True),
])
def test_streamed_archives_and_box_sizes(kind, whole, open_end):
    assert kind != "application/zip" or whole[6] & 8
    found = media.inspect(whole, kind, AUTOMATON)
    assert found[:2] == (kind, False)
    text = b"text before " + whole + (b"" if open_end else b" and after")
    assert [(f.start, f.end) for f in media.sniff(text, AUTOMATON)][0] == (12, 12 + len(whole))


WHOLE = {"image/png": png(), "image/gif": gif(), "image/jpeg": jpeg(), "image/bmp": bmp(), "application/zip": zipped(), "application/gzip": gzip.compress(b"x" * 200_000), "audio/wav": media.to_wav(b"12"), "application/pdf": b"%PDF-1.4\n1 0 obj\nstartxref\n0\n%%EOF", "video/mp4": struct.pack(">I", 16) + b"ftypisom\0\0\0\0" + struct.pack(">I", 8) + b"moov"}


@pytest.mark.parametrize("kind", WHOLE)
def test_types_are_found_confirmed_and_carved(kind):
    data = WHOLE[kind]
    got = media.inspect(data, "text/plain", AUTOMATON)
    assert got[0] == kind and got[1] and got[4] == []
    wrapped = b"some text " + data + b" more"
    found = media.sniff(wrapped, AUTOMATON)
    assert (kind, data) in list(media.carve(wrapped, found))
    assert media.true_type(wrapped, found) == "application/octet-stream"
    assert not [x for x in media.sniff(data[: len(data) - 3], AUTOMATON) if x.kind == kind and x.start == 0]


def test_signatures_in_plain_text_confirm_nothing():
    text = b"BM PK\3\4 GIF89a %PDF-1.4 RIFFxxxxWAVE OggS ftyp \x1f\x8b\x08 " * 2000
    assert media.sniff(text, AUTOMATON) == []
    assert media.inspect(None, None, AUTOMATON) == ("application/octet-stream", False, None, None, [])


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=300))
def test_random_bytes_never_crash_and_wav_round_trips(data):
    media.sniff(data, AUTOMATON)
    for magic in (x[1] for x in media.SIGNATURES):
        media.sniff(magic + data, AUTOMATON)
    payload = media.padded(data)
    assert len(payload) % 64 == 0 and payload and payload[: len(data)] == data and not any(payload[len(data) :])
    stored = media.to_wav(payload)
    kind, _, start, end, _ = media.inspect(stored, None, AUTOMATON)
    assert kind == "audio/wav" and stored[start:end] == payload


def test_media_query(spark, sf_dir):
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    features = {}
    for r in queries.op4_media(spark, sf_dir).collect():
        raw = docs[r["doc_id"]]
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        assert (r["n_bytes"], r["payload_bytes"], r["media_bytes"]) == (len(raw), len(payload), len(payload) + 44)
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-64:])
        assert features.setdefault(raw, r["feature"]) == r["feature"]


def plain_sniff(data):
    """Every validator at every offset where its signature stands."""
    found, spent = {}, {}
    at = sorted((i + len(magic), k, i - offset) for k, (_, magic, offset, _) in enumerate(media.SIGNATURES) for i in range(len(data)) if data.startswith(magic, i))
    for _, k, start in at:
        kind, _, _, validate = media.SIGNATURES[k]
        if start < 0 or (kind in ("audio/ogg", "application/zip", "application/pdf") and start < spent.get(k, 0)):
            continue
        if got := validate(data, start):
            if start not in found or found[start].end < got[0]:
                found[start] = media.Found(kind, start, *got)
            spent[k] = max(spent.get(k, 0), got[0])
    return sorted(found.values(), key=lambda x: (x.start, -x.end))


def test_sniffing_equals_a_look_at_every_offset():
    r, automaton = random.Random(21), media.signature_automaton()
    whole = [media.to_wav(media.padded(b"abc" * 40)), gzip.compress(b"x" * 5000), gzip.compress(bytes(r.randrange(256) for _ in range(300)))]
    magics = [m for _, m, _, _ in media.SIGNATURES]
    confirmed = 0
    for _ in range(150):
        parts = [r.choice([r.choice(whole), r.choice(magics), bytes(r.randrange(256) for _ in range(r.randrange(40))), r.choice(whole)[: r.randrange(60)]]) for _ in range(r.randrange(1, 7))]
        data = b"".join(parts)
        got = media.sniff(data, automaton)
        assert got == plain_sniff(data)
        confirmed += len(got)
    assert confirmed > 100


def test_large_and_broken_compressed_objects():
    automaton = media.signature_automaton()
    big = gzip.compress(bytes(20_000_000))
    assert [(x.kind, x.start, x.end) for x in media.sniff(b"--" + big + b"--", automaton)] == [("application/gzip", 2, 2 + len(big))]
    assert media.sniff(big[:-9], automaton) == [] and media.sniff(big[:500] + b"!" + big[501:], automaton) in ([], media.sniff(big[:500] + b"!" + big[501:], automaton))


def test_the_gate_loses_no_detection():
    """All rules on all texts, against the rules that the keywords let through."""
    r, scanner = random.Random(22), licenses.LicenseScanner()
    known = licenses.rules()
    words = sorted({w for rule in known for w in re.findall("[0-9a-z]+", rule.pattern.pattern) if len(w) > 1} | {"the", "of", "and", "a"})
    open_gate = licenses.LicenseScanner([licenses.Rule(x.label, x.priority, tuple("abcdefghijklmnopqrstuvwxyz0123456789"), x.pattern, x.base) for x in known])
    phrases = ["mit 0 license", "the x consortium", "zero clause bsd", "asl 2 0", "bsl 1 0", "creative commons zero", "open data commons public domain dedication", "odc odbl", "open data commons attribution license", "psf license agreement", "png reference library license", "do what the fuck you want to public license"]
    texts = phrases + [" ".join(r.choice([r.choice(words), r.choice(phrases), r.choice(words)]) for _ in range(r.randrange(1, 60))) for _ in range(300)]
    assert all(scanner.scan(p)[1] for p in phrases)
    for text in texts:
        assert scanner.scan(text) == open_gate.scan(text), text


def test_row_operators_take_odd_rows(spark, tmp_path):
    """Null, empty and very long texts, repeated rows and ids, clashing names and empty tables, through the queries themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, n_words string, feature string, ids_sha256 string"
    rows = [(1, None), (2, ""), (None, "mit license"), (3, "MIT License " * 20_000), (4, "a b"), (4, "a b"), (4, "b a")]
    for name, given in (("rows", rows), ("none", [])):
        spark.createDataFrame([(d, t, None, None, None, "s", "w", "f", "h") for d, t in given], schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        for query in ("op1_sentencepiece", "op4_media", "op10_licenses"):
            out = queries.QUERIES[query](spark, f"{tmp_path}/{name}").collect()
            assert sorted((r["doc_id"] or 0) for r in out) == sorted((d or 0) for d, _ in given), query
            if given:
                by = {}
                for r in out:
                    by.setdefault(r["doc_id"], []).append(tuple(r)[1:])
                assert by[1] == by[2] and len(by[4]) == 3 and len(set(by[4])) == (1 if query == "op10_licenses" else 2)
