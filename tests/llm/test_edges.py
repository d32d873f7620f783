"""Every operator on rows with nulls, empty and very long texts, ties, repeats
and clashing names, against a plain version; and on an empty table."""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import brute
from kiln.llm import chat, exact, idfile, mix, neardup, pack, pii, quality, substring, warc
from kiln.llm.common import join_hot, work_dir

WORD_BPE, BYTE_BPE = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))


def _ids(path: str, text: str | None) -> list[int]:
    from tokenizers import Tokenizer
    return [*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, 1]


def _crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def _rows(df) -> list[tuple]:
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_join_hot_equals_a_join(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
                                    F.col("id").alias("v")).union(spark.sql("SELECT CAST(NULL AS STRING), -1L"))
    table = rows.select("k").distinct().withColumn("w", F.length("k"))
    got = join_hot(rows, table, ["k"]).collect()
    assert len(got) == 5001 and sum(r.k == "hot" for r in got) == 2500 and sum(r.k is None for r in got) == 1
    left = join_hot(rows, table.filter("k = 'hot'"), ["k"], "left")
    assert left.count() == 5001 and left.filter("w IS NULL").count() == 2501


def test_exact(odd):
    groups = defaultdict(list)
    for i, t in _rows(odd):
        groups[t or ""].append(i)
    expected = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = 1
        for i in ids:
            stays = i == keep and left == 1
            left -= stays
            expected[i, keep, len(ids), stays, hashlib.sha256(t.encode()).hexdigest()] += 1
    got = exact.mark_copies(odd)
    assert Counter(tuple(r) for r in got.collect()) == expected
    kept = exact.exact_dedup(odd)
    assert kept.columns == odd.columns
    assert sorted((t or "") for _, t in _rows(kept)) == sorted(groups)
    assert {i for i, _ in _rows(kept)} == {k[1] for k in expected}


def test_exact_with_a_full_filter(spark):
    """Every row is suspected when the filter is far too small: still exact."""
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 19_000).cast("string").alias("text"))
    exact_bits = exact.BITS_PER_ROW
    try:
        exact.BITS_PER_ROW = 1
        r = exact.mark_copies(docs)
        assert r.filter("kept").count() == 19_000 and r.filter("group_size = 2").count() == 2000
    finally:
        exact.BITS_PER_ROW = exact_bits


def test_substring(odd):
    for window in (35, 13):
        assert substring.levels(35) == [18, 35]
        rows = _rows(odd)
        expected = Counter((i, *x) for (i, _), x in zip(rows, brute.removed([t for _, t in rows], window)))
        assert Counter(tuple(r) for r in substring.removed(odd, window).collect()) == expected
    out = substring.without_repeats(odd, 35)
    assert out.columns == odd.columns and out.count() == odd.count()


def test_substring_random(spark):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"t{x}" for x in rng.integers(0, 2, rng.integers(0, 60))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for window in (1, 5, 13, 30):
        expected = {(i, *x) for i, x in enumerate(brute.removed(texts, window))}
        assert {tuple(r) for r in substring.removed(df, window).collect()} == expected


def test_near(odd):
    rows = _rows(odd)
    expected = brute.near_classes([i for i, _ in rows], [t for _, t in rows])
    got = neardup.classes(odd).select("doc_id", "class_id").collect()
    assert Counter(tuple(r) for r in got) == Counter((rows[i][0], c) for i, c in expected.items())
    kept = neardup.near_dedup(odd)
    assert kept.columns == odd.columns
    assert {i for i, _ in _rows(kept)} == {c for c in expected.values()}


@pytest.mark.parametrize("group,large", [(12, 1 << 14), (12, 30)])
def test_near_large_buckets(spark, monkeypatch, group, large):
    """A family of near copies, and many texts that share only a passage, with
    bounds so small that buckets are cut into blocks and dealt anew."""
    monkeypatch.setattr(neardup, "GROUP", group)
    monkeypatch.setattr(neardup, "LARGE", large)
    rng = np.random.default_rng(2)
    base = [f"b{i}" for i in range(150)]
    texts = []
    for k in range(60):
        w = list(base)
        for at in rng.integers(0, 150, 3):
            w[at] = f"c{k}-{at}"
        texts.append(" ".join(w))
    for k in range(80):
        texts.append(" ".join([f"p{i}" for i in range(70)] + [f"d{k}-{i}" for i in range(int(rng.integers(15, 50)))]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = brute.near_classes(list(range(len(texts))), texts)
    got = {r.doc_id: r.class_id for r in neardup.classes(df).collect()}
    assert got == expected


def test_near_leaves_no_bucket_out(spark, monkeypatch):
    """All texts stand in one bucket of the last band and share a passage; the
    bucket exceeds ``LARGE``."""
    monkeypatch.setattr(neardup, "LARGE", 4)
    passage = " ".join(f"common{i}" for i in range(12))
    texts = []
    for k in range(20):
        own = [f"t{k}x{i}" for i in range(100)]
        texts += [" ".join([passage, *own]), " ".join([passage, *own[:97], "other", *own[98:], "twice", "twice"])]
    nodes = spark.createDataFrame(list(enumerate(texts)), "rid long, text string")
    bags = nodes.mapInArrow(neardup._bags(5), "rid long, shingles binary, counts binary, fine binary").cache()
    nodes = nodes.withColumn("bands", F.array_repeat(F.lit(7).cast("long"), neardup.BANDS))
    members = nodes.select(F.lit(7).cast("long").alias("bucket"), F.lit(neardup.BANDS - 1).alias("band"), "rid",
                           F.size(F.split("text", " ")).cast("long").alias("words"))
    members = members.select("bucket", "band", "rid", (F.col("words") - 4).alias("size")).cache()
    search = neardup._Search(nodes, bags, neardup.THRESHOLD)
    search.run(members)
    assert {(r.a, r.b) for r in search.links.collect()} == {(2 * k, 2 * k + 1) for k in range(20)}


def test_quality_statistics(odd):
    got = quality.verdicts(odd).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "marks", "base_failed")
    expected = Counter((i, *[brute.base_statistics(t)[n] for n in names]) for i, t in _rows(odd))
    assert Counter((r["id"], *[r[n] for n in names]) for r in got) == expected
    assert all(r["kept"] == (not r["base_failed"]) for r in got)  # too few texts for an estimate
    assert quality.good_documents(odd).columns == odd.columns


def test_mix(odd):
    rows = odd.select("doc_id", "text", "source").collect()
    sizes = [len(brute.words(r.text)) for r in rows]
    per = Counter()
    for r, n in zip(rows, sizes):
        per[r.source] += n
    names = sorted((s for s in per if s is not None), key=lambda s: s.encode()) + ([None] if None in per else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, capped = {}, set()
    while True:
        rest = sum(per.values()) - sum(3 * per[s] for s in capped)
        free = [s for s in names if s not in capped]
        level = rest / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if level * weight[s] > 3 * per[s]}
        if not over:
            break
        capped |= over
    target = {s: 3 * per[s] if s in capped else level * weight[s] for s in names}
    got = mix.taken(odd).collect()
    assert Counter((r.doc_id, r["size"], r.source_size) for r in got) == Counter(
        (r.doc_id, n, per[r.source]) for r, n in zip(rows, sizes))
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.target] += r.taken
    expected = Counter()
    for s in names:
        expected[target[s]] += target[s]
    for t, words in expected.items():
        near = [k for k in taken if abs(k - t) < 1e-6 * max(t, 1)]
        assert len(near) == 1 and abs(taken[near[0]] - words) <= len(names)
    assert sorted(map(str, got)) == sorted(map(str, mix.taken(odd).collect()))
    out = mix.mixed_documents(odd)
    assert out.columns == odd.columns
    mixed = Counter()
    for r in out.collect():
        mixed[r.source] += len(brute.words(r.text))
    assert sum(mixed.values()) == sum(r.taken for r in got)
    first = {}
    for r in got:
        assert (r.first_slot is None) == (r.taken == 0)
        if r.taken:
            first[r.doc_id] = min(first.get(r.doc_id, r.first_slot), r.first_slot)
    order = [r.doc_id for r in out.collect()]
    places = [first[i] for i in dict.fromkeys(order)]  # first readings
    assert places == sorted(places)


def test_mixed_documents_stand_near_targets_in_every_prefix(spark):
    rows = [(i, f"w{i} " * 20, "abc"[i % 3]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = mix.mixed_documents(docs).collect()
    assert len(out) >= 3000
    met = Counter()
    for n, r in enumerate(out, 1):
        met[r.source] += 1
        if n % 300 == 0:
            assert all(abs(met[s] - n * w / 6) <= 0.01 * n + 5 for s, w in zip("abc", (1, 2, 3)))


def test_schedule_keeps_every_prefix_near_its_targets(spark):
    per = spark.createDataFrame([("a", 600.0, 600), ("b", 300.0, 300), ("c", 100.0, 100)], "source string, target double, words long")
    slots = sorted(mix.schedule(per, 1, 1000).collect())
    assert len(slots) == 1000 and len({(s, b) for _, s, b in slots}) == 1000
    met = Counter()
    for n, (_, s, b) in enumerate(slots, 1):
        assert b == met[s]
        met[s] += 1
        assert abs(met["a"] - 0.6 * n) < 6 and abs(met["c"] - 0.1 * n) < 6


def test_token_files(odd, spark):
    back = idfile.round_trip(odd, WORD_BPE).collect()
    rows = sorted(_rows(odd), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, expected = 0, []
    for i, t in rows:
        ids = _ids(WORD_BPE, t)
        expected.append((i, start, np.array(ids, "<u4").tobytes()))
        start += len(ids)
    got = sorted(back, key=lambda r: r.start)
    assert [(r.doc_id, r.start, bytes(r.ids)) for r in got] == expected


@pytest.mark.parametrize("capacity", [1, 2, 16, 2048])
def test_bins_hold_their_class_and_one_cut(capacity):
    random = np.random.default_rng(3)
    lengths = random.integers(1, max(capacity, 2), 3000) if capacity > 1 else []
    bins, full = pack.Bins(capacity), []
    for i, n in enumerate(lengths):
        full += bins.add(pack.Piece(i, 0, int(n), np.full(n, i, "<u4").tobytes()))
        assert sum(len(m) for m in bins.open.values()) <= sum(bins.open) and len(bins.open) <= 2 * capacity ** 0.5 + 1
    last = bins.close()
    back = Counter()
    for b in full:
        sizes = [len(p.raw) // 4 for p in b]
        k = capacity // sizes[0]
        assert sum(sizes) == capacity and all(capacity // n == k for n in sizes[:k])
        assert sum(sizes[:k]) * (k + 1) > k * capacity - 1
        assert all(p.start + n == p.tokens for p, n in zip(b[k:-1], sizes[k:-1]))  # only the last one is cut
    for b in last:
        n = sum(len(p.raw) // 4 for p in b)
        assert n & (n - 1) == 0 and n <= capacity
    pieces = sorted((p.doc, p.start, p.raw) for b in full + last for p in b)
    assert len(pieces) <= len(lengths) + len(full) + len(last)
    for doc, start, raw in pieces:
        assert back[doc] == start and raw == np.full(len(raw) // 4, doc, "<u4").tobytes()
        back[doc] += len(raw) // 4
    assert back == Counter({i: int(n) for i, n in enumerate(lengths)})


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pack(odd, capacity):
    got = pack.pack(odd, BYTE_BPE, "space", capacity).collect()
    by_doc, fill, at = Counter(), Counter(), defaultdict(list)
    expected = Counter()
    for i, t in _rows(odd):
        expected[i] += len(_ids(BYTE_BPE, t))
    for r in got:
        by_doc[r.doc_id] += r["length"]
        fill[r.sequence_id] += r["length"]
        at[r.sequence_id].append((r.offset, r["length"]))
        assert r["length"] * 4 == len(r.ids)
    assert by_doc == expected
    for s, n in fill.items():
        assert n <= capacity and n & (n - 1) == 0  # full, or a power of two: no padding
        ends = 0
        for offset, length in sorted(at[s]):
            assert offset == ends
            ends += length
    assert sum(n == capacity for n in fill.values()) >= sum(fill.values()) // capacity - 60
    once = [(i, t) for i, t in _rows(odd) if i in (1, 11, 14)]
    for i, t in once:
        pieces = sorted((r.start, bytes(r.ids)) for r in got if r.doc_id == i)
        assert b"".join(x for _, x in pieces) == np.array(_ids(BYTE_BPE, t), "<u4").tobytes()


def test_warc(spark):
    big = "<p>" + "same " * 50
    pages = [(5, "http://a.b/ with blanks", big), (3, "http://a.c", big), (None, "http://x", big), (9, None, None), (8, "u", ""),
             (7, "http://short", "tiny"), (6, "http://short2", "tiny"), (3, "http://a.c", big), (-4, "http://neg", "é" * 200)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    files = warc.write(warc.to_arc(df), work_dir(spark, "t-warc"))
    got = warc.read(files).collect()
    assert len(got) == len(pages)
    assert Counter((r.row, r.payload_bytes, r.record_type, r.refers_to) for r in got) == Counter([
        (5, len(big), "revisit", 3), (3, len(big), "response", None), (3, len(big), "response", None),
        (None, len(big), "revisit", 3), (9, 0, "response", None), (8, 0, "response", None), (7, 4, "response", None),
        (6, 4, "response", None), (-4, 400, "response", None)])
    assert {r.payload_digest for r in got if r.row == 9} == {hashlib.sha256(b"").hexdigest()}


def test_archives_of_many_records(spark, tmp_path):
    """Files by path and as values: packed or not, joined, with servers' heads."""
    body = b"<html>" + b"x" * 300
    heads = [b"HTTP/1.1 200 OK\r\nContent-Length: 7\r\nServer: a\r\n\r\n", b"HTTP/1.0 404 Gone\nX: y\n\n", b""]
    one, two = (warc.arc_version_block(v, "x", "20010203040506") for v in (1, 2))
    rec = [warc.arc_record(1, f"http://h/{i}", "20010203040506", h + body) for i, h in enumerate(heads)]
    late = warc.arc_record(2, "http://h/late", "20010203", heads[0] + b"HTTP/1.1 inside\r\n\r\n")
    plain, members = one + b"".join(rec) + two + late, b"".join(gzip.compress(x) for x in [one, *rec])
    (tmp_path / "a.arc").write_bytes(plain)
    (tmp_path / "b.arc.gz").write_bytes(members)
    (tmp_path / "c.arc").write_bytes(one)
    digest = hashlib.sha256(body).hexdigest()
    inner = b"HTTP/1.1 inside\r\n\r\n"
    expected = Counter({(1, "http://h/0", "response", len(body), digest, None): 1,
                        (1, "http://h/late", "response", len(inner), hashlib.sha256(inner).hexdigest(), None): 1})
    expected.update([(1, f"http://h/{i}", "revisit", len(body), digest, 1) for i in (1, 2)])
    expected.update([(2, f"http://h/{i}", "revisit", len(body), digest, 1) for i in (0, 1, 2)])
    by_path = spark.createDataFrame([(1, str(tmp_path / "a.arc")), (2, str(tmp_path / "b.arc.gz")),
                                     (3, str(tmp_path / "c.arc")), (4, None)], "row long, path string")
    by_value = spark.createDataFrame([(1, plain), (2, members), (3, one), (4, None)], "row long, arc binary")
    for arcs in (by_path, by_value):
        files = warc.write(arcs, work_dir(spark, "t-arcs"))
        got = warc.read(files).collect()
        assert Counter((r.row, r.target_uri, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to) for r in got) == expected
        assert len({r.record_id for r in got}) == len(got)
        blocks = {}
        for f in files.collect():
            with gzip.open(f.path.removeprefix("file:")) as stream:
                blocks.update((h["WARC-Record-ID"], (h, b)) for h, b in warc.parse_warc(stream))
        for h, b in blocks.values():
            if h["WARC-Target-URI"] == "http://h/1":
                assert b == heads[1]  # the server's own head, once, without the payload
            if "WARC-Refers-To" in h:
                assert blocks[h["WARC-Refers-To"]][0]["WARC-Target-URI"] == "http://h/0"
    with pytest.raises(ValueError):
        list(warc.parse_arc(rec[0]))


def test_arc_versions_and_bad_lines():
    for version in (1, 2):
        raw = warc.arc_version_block(version, "x", "20010203040506") + warc.arc_record(version, "http://u r l/", "20010203", b"body\n\n")
        (head, body), = warc.parse_arc(raw)
        assert head["URL"] == "http://u r l/" and body == b"body\n\n" and warc.warc_date(head["Archive-date"]) == "2001-02-03T00:00:00Z"
    with pytest.raises(ValueError):
        list(warc.parse_arc(raw[:-3]))
    for row in (0, 1, -1, 2**63 - 1, -2**63):
        assert warc.row_of(warc.record_id(row, b"\x01" * 32)) == row
    assert warc.row_of(warc.record_id(None, b"\x01" * 32)) is None


def test_pii(odd, spark):
    out = pii.replace_entities(odd, "k")
    assert out.columns == [*odd.columns, "n_replaced"]
    assert Counter(_rows(out)) == Counter(_rows(odd))  # nothing private in these
    texts = ["mail a.b@x.org or A.B@X.ORG and c.d@x.org", "+1 (743) 555-3824 and +1 743 555 3824",
             "4111 1111 1111 1111, 4111111111111111", "1.2.3.4 version 1.2.3.4.5", 'token = "00ffAA1122334455"',
             "Mrs. Anna Smith, Mrs. Smith, Mr. Smith", "госпожа Иванова", None, "", "no entity 2024"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_replaced) for r in pii.replace_entities(df, "k").collect()}
    a, _, b, _, c = got[0][0].removeprefix("mail ").split(" ")
    assert a.lower() == b.lower() and b.isupper() and c != a and c.split("@")[1] == a.split("@")[1] and a.endswith(".org")
    x, y = got[1][0].split(" and ")
    digits = lambda s: "".join(ch for ch in s if ch.isdigit())
    assert digits(x) == digits(y) != digits(texts[1].split(" and ")[0]) and x[:4] == "+1 ("
    p, q = got[2][0].split(", ")
    assert p.replace(" ", "") == q and q != "4111111111111111" and q[0] == "4"
    assert sum(sum(divmod(int(ch) * (1 + k % 2), 10)) for k, ch in enumerate(reversed(q))) % 10 == 0
    assert got[3][0].endswith("version 1.2.3.4.5") and not got[3][0].startswith("1.2.3.4 ") and got[3][1] == 1
    assert got[4][0].startswith('token = "') and got[4][0].endswith('"') and "00ff" not in got[4][0]
    first, second, third = got[5][0].split(", ")
    assert first.split()[-1] == second.split()[-1] and first.startswith("Mrs. ") and "Smith" not in got[5][0]
    assert got[6][0].endswith("ова") and "Иванова" not in got[6][0]
    assert got[7] == (None, 0) and got[8] == ("", 0) and got[9] == ("no entity 2024", 0)


def test_pii_names_without_title_and_long_secrets(spark):
    jwt, blob, gap = "eyJ" + "aB3.-_" * 60, "0123456789abcdef" * 5000, "s3cretvalue"
    texts = ["Mrs. Anna Smith called. Later Anna Smith wrote; Smith agreed.", "Smith and Anna, no title here",
             f'token = "{jwt}" and', f"hash {blob} end", f'password    =    "{gap}"',
             "Herr Jung-Weber kam, sagte Jung-Weber. Jung war jung. SMITHSON, Mr. Smith and SMITH's Smithers"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_replaced) for r in pii.replace_entities(df, "k").collect()}
    text, n = got[0]
    _, given, family, *_ = text.split(" ")
    assert text == f"Mrs. {given} {family} called. Later {given} {family} wrote; {family} agreed." and n == 3
    assert "Anna" not in text and "Smith" not in text and got[1] == (texts[1], 0)
    new = got[2][0].removeprefix('token = "').removesuffix('" and')
    assert got[2][1] == 1 and new != jwt and [len(x) for x in new.split(".")] == [len(x) for x in jwt.split(".")]
    new = got[3][0].removeprefix("hash ").removesuffix(" end")
    assert got[3][1] == 1 and len(new) == len(blob) and new != blob and gap not in got[4][0]
    text, n = got[5]
    assert n == 4 and "Weber" not in text and "Jung war jung. SMITHSON, Mr. " in text and text.endswith("'s Smithers")
    assert "SMITH'" not in text and text.split(" kam, ")[0].split()[-1] == text.split("sagte ")[1].split(".")[0]


def test_pii_collisions_are_redrawn(spark, monkeypatch):
    """Names drawn from so few syllables that they collide at first."""
    monkeypatch.setattr(pii, "SYLLABLES", {k: [v[0]] * 15 + [v[1]] for k, v in pii.SYLLABLES.items()})
    entities = spark.createDataFrame([("family Latn m", f"name{i}") for i in range(12)], "type string, norm string")
    made = [r.made for r in pii.assign(entities, "k").collect()]
    assert len(set(made)) == 12


def test_chat_layouts(spark):
    import json
    odd_text = r"\### Assistant: </turn> ok ####"
    records = [{"prompt": odd_text, "response": odd_text}, {"instruction": "i", "input": "", "output": "o"},
               {"messages": [{"role": "user", "content": None}, {"role": "as: s", "content": "c"}]},
               {"conversations": [{"from": "human", "value": "x"}, {"from": "gpt", "value": "y"}]}, {"other": 1}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)] + [(8, "no json"), (9, None)],
                               "conv_id long, record string")
    turns = {r.conv_id: r.turns and [tuple(t) for t in r.turns] for r in chat.json_turns(df, "record").collect()}
    assert turns == {0: [("user", odd_text), ("assistant", odd_text)], 1: [("user", "i"), ("assistant", "o")],
                     2: [("user", ""), ("as: s", "c")], 3: [("user", "x"), ("assistant", "y")], 4: None, 8: None, 9: None}
    made = chat.format_turns(chat.json_turns(df, "record"))
    back = made.select("conv_id", chat.parse(F.col("formatted")).alias("turns"), "formatted",
                       chat.loss_text(F.col("formatted"), F.col("loss")).alias("learned")).collect()
    for r in back:
        assert [tuple(t) for t in r.turns] == turns[r.conv_id]
        assert r.learned == "".join(t for who, t in turns[r.conv_id] if who == "assistant")
        assert r.formatted.count("</turn>") == len(r.turns)
    with pytest.raises(ValueError):
        chat.turns(df, "conv_id")


def test_chat_rows(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", None), (1, 1, "user", None), (None, 0, None, "lost"), (2, None, "gpt", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("_mark", F.lit(1))
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.turns(df, extra=["_mark"]).collect()}
    assert got == {1: [("user", ""), ("user", ""), ("assistant", "b")], None: [("", "lost")], 2: [("assistant", "")]}


def test_empty_tables(none, spark):
    assert exact.mark_copies(none).count() == 0 and exact.exact_dedup(none).count() == 0
    assert substring.removed(none).count() == 0 and substring.without_repeats(none).count() == 0
    assert neardup.classes(none).count() == 0 and neardup.near_dedup(none).count() == 0
    assert quality.verdicts(none).count() == 0 and quality.good_documents(none).count() == 0
    assert mix.taken(none).count() == 0 and mix.mixed_documents(none).count() == 0
    assert idfile.round_trip(none, WORD_BPE).count() == 0
    assert pack.pack(none, BYTE_BPE).count() == 0
    assert pii.replace_entities(none, "k").count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read(warc.write(warc.to_arc(pages), work_dir(spark, "t-warc"))).count() == 0
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_turns(chat.turns(rows)).count() == 0


def test_helper_names_that_the_input_has_already(spark):
    """Columns named like helper columns of earlier versions."""
    rows = [(i, f"Mrs. Anna Smith{i % 3} wrote {i} words to a@b{i}.org " + "w " * (i % 5), "en", "s", 40) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df = df.withColumns({c: F.lit(1) for c in ("_new", "_ath", "_ati", "_key0", "_salt", "_copies", "0")})
    assert pii.replace_entities(df, key="k").count() == 12
    assert mix.mixed_documents(df).columns == df.columns
    assert substring.without_repeats(df, 35).columns == df.columns
    assert exact.exact_dedup(df).count() == 12
