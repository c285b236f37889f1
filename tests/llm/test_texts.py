"""Secrets, cleaning, quality and toxicity against plain Python and held-out labels."""

from __future__ import annotations

import base64
import bz2
import gzip
import hashlib
import itertools
import lzma
import re
import time
import urllib.parse
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import cleaning, quality, secrets, toxicity
from starloom.llm.labelled import held_out, training_rows
from test_native import ODD, odd

TABLES = "/root/testdata/sf0.01"
SECRET = 'password="hunter2hunter2"'


def spans(text):
    return secrets.unwrap(text)[1]


@pytest.mark.parametrize(
    "wrap",
    [
        lambda s: urllib.parse.quote(s, safe=""),
        lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
        lambda s: "".join(f"&#{ord(c)};" for c in s),
        lambda s: base64.b64encode(s.encode()).decode(),
        lambda s: base64.urlsafe_b64encode(b"\xc3\xbf\xc3\xbe " + s.encode()).decode(),
        lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
        lambda s: base64.b64encode(zlib.compress(gzip.compress(s.encode()))).decode(),
        lambda s: base64.b64encode(base64.b64encode(urllib.parse.quote(s, safe="").encode())).decode(),
        lambda s: urllib.parse.quote(base64.b64encode(s.encode()).decode(), safe=""),
        lambda s: urllib.parse.quote(zlib.compress(s.encode())),
    ],
)
def test_layers_are_unwrapped_and_mapped(wrap):
    coded = wrap(SECRET)
    text = f"é before {coded} after"
    found = spans(text)
    assert [k for k, _, _ in found] == ["assign"]
    _, a, b = found[0]
    assert 9 <= a < b <= 9 + len(coded)
    assert secrets.unwrap(text)[0] == []


NOISE = "\n".join(hashlib.sha256(bytes([i])).hexdigest()[:20] for i in range(40))  # makes layers long; no run of 32 for a key


def in_lines(data, width, before="", after="\n", alphabet=base64.b64encode):
    coded = alphabet(data).decode()
    return after.join(before + coded[i : i + width] for i in range(0, len(coded), width))


def raw_deflate(data):
    tool = zlib.compressobj(9, zlib.DEFLATED, -15)
    return tool.compress(data) + tool.flush()


LONG = (NOISE + "\n" + SECRET).encode()
MISSED = {
    **{f"gzip in lines of {w}": in_lines(gzip.compress(LONG), w) for w in (32, 48, 56, 60, 64, 76, 77, 80, 100, 128)},
    **{f"url alphabet in lines of {w}": in_lines(gzip.compress(LONG), w, alphabet=base64.urlsafe_b64encode) for w in (32, 64, 76, 100)},
    **{f"plain in lines of {w}": in_lines(LONG, w) for w in (32, 76, 80)},
    "windows line ends": in_lines(gzip.compress(LONG), 76, after="\r\n"),
    "indented": in_lines(gzip.compress(LONG), 64, before="    "),
    "quoted mail": in_lines(gzip.compress(LONG), 72, before="> "),
    "joined texts": in_lines(gzip.compress(LONG), 60, before='  "', after='"\n') + '"',
    "joined by signs": in_lines(gzip.compress(LONG), 60, before="  '", after="' +\n") + "'",
    "continued lines": in_lines(gzip.compress(LONG), 60, after="\\\n"),
    "utf-16 without mark": base64.b64encode(("x = 1; " + SECRET).encode("utf-16-le")).decode(),
    "utf-16, high byte first": base64.b64encode(("x = 1; " + SECRET).encode("utf-16-be")).decode(),
    "raw deflate": base64.b64encode(raw_deflate(LONG)).decode(),
    "gzip in raw deflate": base64.b64encode(raw_deflate(gzip.compress(LONG))).decode(),
    "escaped bytes": "".join(f"\\x{b:02x}" for b in gzip.compress(LONG)),
    "bytes as python writes them": str(gzip.compress(LONG, mtime=0))[2:-1],
}


@pytest.mark.parametrize("name", list(MISSED))
def test_layers_of_many_forms(name):
    text = f"key: {MISSED[name]} end"
    _, everything, _, unopened = secrets.unwrap(text)
    assert [k for k, a, b in everything if 0 <= a < b <= len(text)] == ["assign"] and unopened == 0


def test_lines_of_prose_are_no_layers():
    text = "\n".join(f"internationalization-of-words{i}" for i in range(50)) + "\n" + "\n".join(["uncharacteristically"] * 30)
    assert secrets.unwrap(text)[:2] == ([], [])


def test_long_runs_take_little_time():
    text = base64.b64encode(np.random.default_rng(1).bytes(300_000)).decode()
    start = time.perf_counter()
    assert secrets.unwrap(text)[1] == secrets.unwrap(text)[0]
    assert time.perf_counter() - start < 8


def test_spans_in_layers_are_exact():
    inner = "x " + SECRET + " y"
    text = "ab " + urllib.parse.quote(inner, safe="")
    ((_, a, b),) = spans(text)
    assert urllib.parse.unquote(text[a:b]) == SECRET[:-1]  # a closing quote is no part of a match
    text = "ab " + base64.b64encode(inner.encode()).decode()
    ((_, a, b),) = spans(text)
    assert SECRET[:-1] in base64.b64decode(text[3 + (a - 3) // 4 * 4 : b] + "==").decode()


def test_plain_findings_stay_and_overlaps_add():
    text = "token=abcdefgh%41bcd and AKIA" + "A" * 12 + " and " + "0f" * 16 + " AKIAAKIA secret: secret: abcdefghij"
    plain, everything, layers, _ = secrets.unwrap(text)
    assert plain == base(text)
    assert set(plain) < set(everything) and layers == 1


def base(text):
    """The stated patterns, applied as they are written."""
    found = []
    for kind, pattern, least, group in (
        ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
        ("access", r"AKIA[A-Z0-9]+", 16, 0),
        ("hex", r"[0-9a-f]+", 32, 0),
    ):
        for m in re.compile(pattern, re.ASCII).finditer(text):
            if len(m[group]) >= least:
                found.append((kind, *m.span()))
    kinds = ["assign", "access", "hex"]
    return sorted(found, key=lambda s: (s[1], kinds.index(s[0]), s[2]))


def test_packed_data_that_holds_itself_ends():
    text = base64.b64encode(b"no secret in here, just words").decode()
    for _ in range(6):
        text = base64.b64encode(text.encode()).decode()
    plain, everything, layers, unopened = secrets.unwrap(text)
    assert (plain, everything, unopened) == ([], [], 0) and layers == 7


def test_secrets_of_a_table(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    found = {r.doc_id: r for r in secrets.op2(docs).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        plain = base(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in plain)
        r = found[doc_id]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for k, _, _ in plain) for x in secrets.KINDS]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_secrets_of_odd_rows(spark):
    found = secrets.op2(odd(spark)).collect()
    assert len(found) == len(ODD) and all(r.spans == "" for r in found)
    assert secrets.op2(odd(spark, [])).count() == 0


def counted(text):
    """The stated counts, one by one."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(words, words[1:], words[2:]))
    times = {}
    for w in windows:
        times[w] = times.get(w, 0) + 1
    inside = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            copies += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, copies, len(inside), failed


def test_cleaning_counts_of_a_table(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    found = {r.doc_id: r for r in cleaning.op6(docs).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        r = found[doc_id]
        mine = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert mine == counted(text or ""), doc_id
        assert not (r.base_failed and r.kept)


def test_cleaning_keeps_good_and_rejects_bad(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet").select("doc_id", "quality")
    rows = cleaning.op6(docs).join(labels, "doc_id").where("not base_failed").collect()
    assert all(r.kept == bool(r.quality) for r in rows)


def test_lines_that_fail():
    rules = cleaning.Rules()
    for line, rule in {
        "Home | News | Sport | Weather | About": "navigation",
        "Menu": "navigation",
        "We use cookies to improve this site.": "boilerplate",
        "--- 12 :: 34 ---": "punctuation",
        "a### b&&& c$$$ d*** e": "punctuation",
        "BUY!! NOW!! CHEAP!! THINGS!!": "punctuation",
        "A sentence, with words that say something.": None,
        "A heading without a stop": None,
        "": None,
    }.items():
        assert cleaning.line_fails(line, rules) == rule, line


def test_documents_that_lose_too_much():
    good = " ".join(f"word{i}" for i in range(60)) + "."
    menu = " | ".join(f"item{i}" for i in range(90))
    assert cleaning.judge(good, cleaning.Rules())[6]
    assert not cleaning.judge(good + "\n" + menu, cleaning.Rules())[6]
    assert cleaning.judge(good + "\nMenu", cleaning.Rules())[8] == good


def test_cleaning_of_odd_rows(spark):
    found = cleaning.clean(odd(spark)).collect()
    assert len(found) == len(ODD)
    assert all(r.base_failed and not r.kept for r in found)
    assert all((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == counted(r.text or "") for r in found)
    assert cleaning.op6(odd(spark, [])).count() == 0


def test_held_out_rows(spark):
    ids = spark.createDataFrame([(i,) for i in [*range(50), None]], "doc_id bigint")
    for r in ids.select("doc_id", held_out(5, 0).alias("h")).collect():
        assert r.h == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_training_rows_are_bounded(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    assert 400 < training_rows(docs, labels.unionByName(labels), "quality", 5, 0, 500).count() < 600
    none = training_rows(docs, labels.withColumn("quality", F.lit(None).cast("int")), "quality", 5, 0, 500)
    assert none.count() == 0


def accuracy(scored, labels, column):
    rows = scored.where("held_out").join(labels, "doc_id").where(f"{column} is not null").collect()
    return sum(r.predicted == r[column] for r in rows) / len(rows), len(rows)


def test_quality_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.op9(docs, labels)
    rate, n = accuracy(scored, labels, "quality")
    assert n > 40 and rate > 0.95
    # neither held-out labels nor other columns reach a score
    place = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(place, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.op9(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit(None).cast("string")), turned)
    assert sorted(scored.collect()) == sorted(again.collect())


def test_quality_without_labels_of_both_kinds(spark):
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, None)], "doc_id bigint, quality int, toxic int")
    found = quality.op9(odd(spark), labels).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    assert quality.op9(odd(spark, []), labels).count() == 0
    assert len({r.score for r in quality.op9(odd(spark), labels.limit(0)).collect()}) == 1


def test_gradients_lower_the_loss():
    shape = quality.Settings(buckets=1 << 10, epochs=8)
    words = quality.Words(shape)
    texts = [quality.split(t) for t in ["good clean words", "nice plain text", "BUY!! NOW!!", "CHEAP!! STUFF!!"] * 5]
    words.learn(texts)
    rows = [(*quality.features(words, t), int(i % 4 < 2)) for i, t in enumerate(texts)]
    odds, bias = quality.fit(rows, shape)
    logits = [bias + shares @ odds[ids] for ids, shares, _ in rows]
    assert all((x > 0) == bool(y) for x, (_, _, y) in zip(logits, rows))
    assert all(abs(shares.sum() - 1) < 1e-9 for _, shares, _ in rows)


def test_marginals_against_all_sequences():
    random = np.random.default_rng(2)
    lengths = np.array([3, 0, 1, 6])
    starts = np.cumsum(lengths) - lengths
    odds, moves = random.normal(0, 2, lengths.sum()), random.normal(0, 1, (2, 2))
    p, _ = toxicity.marginals(odds, starts, lengths, moves)
    for a, n in zip(starts, lengths):
        total, ones = 0.0, np.zeros(n)
        for tags in itertools.product((0, 1), repeat=int(n)):
            weight = sum(odds[a + i] for i, t in enumerate(tags) if t) + sum(moves[s, t] for s, t in zip(tags, tags[1:]))
            total += np.exp(weight)
            ones += np.exp(weight) * np.array(tags)
        assert np.allclose(p[a : a + n], ones / total)


def test_toxic_spans_are_learnt_from_labels_of_documents():
    random = np.random.default_rng(1)
    plain = [f"w{i}" for i in range(300)]
    texts, toxic = [], []
    for i in range(300):
        words = list(random.choice(plain, 40))
        if i % 5 == 0:
            words.insert(int(random.integers(0, 40)), random.choice(["Grobian!", "grobians", "meanie"]))
        texts.append(" ".join(words))
        toxic.append(int(i % 5 == 0))
    shape = toxicity.Settings()
    model = toxicity.fit(texts, toxic, shape)
    tokens = toxicity.Tokens(shape)
    tests = ["w1 w2 grobian w3 w4", "w1 w2 w3 w4 w5", "Meanie w9", ""]
    docs = [tokens.text(t) for t in tests]
    p = toxicity.probabilities(tokens, docs, model)
    assert [int(np.argmax(x)) for x in p[:1]] == [2] and p[0][2] > 0.5 and p[2][0] > 0.5 and p[1].max() < 0.5
    scores = [float(model.scale @ np.array([1.0, *toxicity.evidence(x)])) for x in p]
    assert scores[0] > 0.8 > 0 > scores[1] and scores[3] < 0


def test_toxicity_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.op8(docs, labels)
    rate, n = accuracy(scored, labels, "toxic")
    assert n > 80 and rate > 0.95
    text = {r.doc_id: r.text for r in docs.collect()}
    shown = [r for r in scored.collect() if r.toxic_spans]
    assert shown
    for r in shown:
        for span in r.toxic_spans.split(","):
            a, b = map(int, span.split(":"))
            assert re.fullmatch(r"\w+", text[r.doc_id][a:b])


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 1), (9, 1, None)], "doc_id bigint, quality int, toxic int")
    found = toxicity.op8(odd(spark), labels).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    assert toxicity.op8(odd(spark, []), labels).count() == 0
    tagged = toxicity.tag(odd(spark), toxicity.fit([], []))
    assert "kept" in tagged.columns and tagged.columns.count("score") == 1


@pytest.mark.parametrize("beside", [b"\xe9", b"\x00", b"\x1b[0m", b"\xff\xfe\xfd"])
@pytest.mark.parametrize("pack", [lambda x: x, gzip.compress])
def test_layers_that_are_no_clear_text_are_scanned(beside, pack):
    for data in (beside + b" caf " + SECRET.encode() + b" end", SECRET.encode() + b" " + beside, b"ab " + base64.b64encode(SECRET.encode()) + beside):
        coded = base64.b64encode(pack(data)).decode()
        ((kind, a, b),) = spans(f"é {coded} after")
        assert kind == "assign" and 2 <= a < b <= 2 + len(coded)
        if pack is not gzip.compress and data.startswith(SECRET.encode()):
            assert SECRET[:-1].encode() in base64.b64decode(coded[a - 2 : b - 2] + "==")


@pytest.mark.parametrize("front", ["https://example.com/files/", "/a/", "x+files+", "team_data-", "q-"])
@pytest.mark.parametrize("pack", [lambda x: x, gzip.compress, zlib.compress])
@pytest.mark.parametrize("back", ["", "/view"])
def test_layers_behind_a_path_are_unwrapped(front, pack, back):
    for filler in ("", "???>>>", "plain words that come before, "):
        code = base64.urlsafe_b64encode if front[-1] == "-" else base64.b64encode
        coded = code(pack((filler + SECRET).encode())).decode()
        found = spans(front + coded.rstrip("=") + back)
        assert found and {k for k, _, _ in found} == {"assign"}
        assert any(len(front) <= a < b <= len(front + coded) for _, a, b in found) or back


def test_clear_layers_behind_a_path_count():
    text = "https://example.com/files/" + base64.b64encode(b"just some words, nothing in them at all").decode()
    assert secrets.unwrap(text)[1:3] == ([], 1)


def zstd(data):
    import zstandard

    return zstandard.ZstdCompressor().compress(data)


PACKERS = [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstd]


@pytest.mark.parametrize("pack", PACKERS)
def test_all_members_of_a_layer_are_read(pack):
    filler = b"words before, "
    for data in (pack(filler) + pack(SECRET.encode()), pack(filler + SECRET[:8].encode()) + pack(SECRET[8:].encode()), pack(b"") + pack(pack(b"") + pack(SECRET.encode()))):
        coded = base64.b64encode(data).decode()
        _, found, _, unopened = secrets.unwrap(f"ab {coded} after")
        assert found == [("assign", 3, 3 + len(coded.rstrip("=")))] and unopened == 0
    for data in (pack(filler) + SECRET.encode(), pack(filler) + bz2.compress(SECRET.encode()), pack(filler * 9) + b"\0" * 8 + pack(SECRET.encode())):
        assert {k for k, _, _ in spans(base64.b64encode(data).decode())} == {"assign"}


def test_a_layer_that_breaks_off_is_counted_and_read_as_far_as_it_goes():
    coded = base64.b64encode(gzip.compress(SECRET.encode() + bytes(range(256)) * 9)[:-12]).decode()
    _, found, _, unopened = secrets.unwrap(coded)
    assert [k for k, _, _ in found] == ["assign"] and unopened == 1


@pytest.mark.parametrize("pack", PACKERS)
def test_large_layers_are_read_to_the_end(pack):
    large = b"some words, and more words\n" * (70_000_000 // 27)
    text = base64.b64encode(pack(large + base64.b64encode(zlib.compress(SECRET.encode())))).decode()
    _, found, _, unopened = secrets.unwrap(text)
    assert [k for k, _, _ in found] == ["assign"] and unopened == 0


@pytest.mark.parametrize("inner", [lambda x: x, gzip.compress, lambda x: b"\x1b[0m " + x])
@pytest.mark.parametrize("size", [secrets.CHUNK, 70_000_000])
def test_large_raw_deflate_is_read_to_the_end(inner, size):
    large = b"some words, and more words\n" * (size // 27)
    for data in (large + SECRET.encode(), large + base64.b64encode(zlib.compress(SECRET.encode()))):
        text = base64.b64encode(raw_deflate(inner(data))).decode()
        _, found, _, unopened = secrets.unwrap(f"ab {text} after")
        assert found == [("assign", 3, 3 + len(text.rstrip("=")))] and unopened == 0


def test_raw_deflate_of_any_size_is_unpacked_in_steps(monkeypatch):
    monkeypatch.setattr(secrets, "STEP", 16)
    for size in [*range(60), 1000]:
        whole = bytes(i * i % 251 for i in range(size))
        for data in (whole, b"a" * size):
            packed = raw_deflate(data)
            assert b"".join(secrets._inflating(packed)) == data and secrets._inflated(packed + b"xy") == size
            assert all(secrets._inflated(x) == 0 for x in (packed[:-1], packed + b"xyz"))


def test_nothing_is_lost_where_a_large_layer_is_parted(monkeypatch):
    monkeypatch.setattr(secrets, "STEP", 16)
    monkeypatch.setattr(secrets, "CHUNK", 64)
    inner = base64.b64encode(gzip.compress(SECRET.encode())).decode()
    wrapped = base64.encodebytes(b"x" * 70 + SECRET.encode()).decode()
    wanted = [SECRET, "token : \"" + "z" * 90, "AKIA" + "B" * 40, "0f" * 60, inner, wrapped, "".join(f"%{ord(c):02x}" for c in SECRET), "secret%253D hunterhunter"]
    for piece in wanted:
        for before in range(0, 70, 3):
            for filler in ("some words and on, ", "ab cd of the it", "line.\nline\n"):
                whole = (filler * 9)[: before + 60] + " " + piece + " " + filler * 9
                kinds = {k for k, _, _ in spans(whole)}
                packed = base64.b64encode(zlib.compress(whole.encode())).decode()
                assert kinds and {k for k, _, _ in spans(packed)} == kinds
                wide = base64.b64encode(zlib.compress(whole.encode("utf-16"))).decode()
                assert {k for k, _, _ in spans(wide)} == kinds
