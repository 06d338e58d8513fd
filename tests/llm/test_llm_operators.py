"""The operators against brute force, on the small tables and on odd rows."""

import hashlib
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import xxhash
from llm_brute import ODD, WORD, brute_base, brute_components, brute_fingerprint, brute_kept, brute_repeats, brute_targets, brute_url
from pyspark.sql import functions as F

from plumbline.llm import licences, media, mixing, packing, quality, queries, sharding, simhash, substring, textcore, toxicity, urls
from plumbline.llm.components import components

@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, source string").selectExpr(
        "doc_id", "text", "source", "'en' as lang", "cast(length(text) as long) as n_chars", "1 as fingerprint", "2 as prefix", "3 as cell"
    )


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("doc_id = -1")


def test_simhash_matches_brute_force(docs):
    rows = docs.select("doc_id", "text").collect()
    fps = {r.doc_id: brute_fingerprint(r.text) for r in rows}
    want = brute_components(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (f"{fps[i]:016x}", want[i]) for i in fps}


def test_simhash_tiles_of_a_crowded_partition(spark):
    rng = np.random.default_rng(1)
    base = int(rng.integers(1 << 62))
    fps = sorted({base ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in rng.integers(0, 63, (300, 3))})
    table = spark.createDataFrame([(f, i) for i, f in enumerate(fps)], "fingerprint long, rep long")
    want = brute_components(dict(enumerate(fps)))
    for rows in (8, 100, 8192):
        got = {r.node: r.component for r in components(simhash.links(table, 2, rows)).collect()}
        assert {i: got.get(i, i) for i in want} == want


def test_simhash_odd_rows(odd, none):
    got = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(odd).collect()]
    assert len(got) == len(ODD)
    by = dict(got)
    assert by[1] == by[2] == 1 and by[3] == by[5] == by[6] == 3 and by[9] == by[10] == 9 and by[None] is None
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_representatives(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 7, 8, 9]
    assert simhash.keep_representatives(none).count() == 0


def test_near_copies_go_and_lookalikes_stay(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP_ROWS", 2)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[:-1] + [f"end{i}"])) for i in range(9)] + [(20, "a b c"), (21, "A b  c"), (22, "a b d"), (23, ""), (24, None), (25, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in simhash.keep_representatives(df).collect()} == {0, 20, 22, 23}
    assert {r.doc_id for r in simhash.keep_representatives(df, similarity=1.0).collect()} == {*range(9), 20, 22, 23}


def test_no_two_that_stay_are_near_copies(spark, monkeypatch):
    """Copies that drifted from the smallest id through chained links, and are alike or the same among themselves."""
    monkeypatch.setattr(simhash, "GROUP_ROWS", 16)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 40)
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 30 * 196 * 8)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(400):
        words = list(base)
        for at in rng.integers(0, 200, rng.integers(0, 8)):
            words[at] = f"x{rng.integers(0, 3)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, t) for i, t in rows[::4]]
    want = brute_kept(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id for r in simhash.keep_representatives(df).collect()}
    assert len(want) > 80  # more than two rounds
    assert len(got ^ want) <= 0.1 * len(want)  # of texts this drifted some pairs are no candidates
    group = {r.id: r.rep for r in simhash.candidate_groups(df, "doc_id", "text", 5, simhash.CANDIDATE_RADIUS, 42).collect()}
    assert got == {i for rep in set(group.values()) for i in brute_kept([r for r in rows if group[r[0]] == rep])}


def test_members_left_over_take_few_rounds(spark, monkeypatch):
    """A group of very many members that are alike to none, some that are, and a chain of rows each alike to the last."""
    rounds = []
    alike = simhash._among
    monkeypatch.setattr(simhash, "_among", lambda rows: rounds.append(1) or alike(rows))
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 4096)
    n = 50_000
    text = F.concat_ws(" ", F.lit("same five words for all"), *[F.xxhash64(F.lit(k), "id").cast("string") for k in range(10)])
    unlike = spark.range(1, n).select(F.col("id").alias("doc_id"), text.alias("text"))
    near = unlike.where("doc_id % 100 = 7").select((F.col("doc_id") + 10 * n).alias("doc_id"), F.concat("text", F.lit(" more")).alias("text"))
    words = [f"c{i}" for i in range(90)]
    chain = [(20 * n + i, " ".join(words[3 * i : 3 * i + 40])) for i in range(16)]
    docs = simhash.cut(unlike.union(near).union(spark.createDataFrame(chain, "doc_id long, text string")).union(spark.createDataFrame([(0, "another text of five words and more")], "doc_id long, text string")))
    groups = docs.select(F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("rep"))
    gone = {r.drop_id for r in simhash.verified(docs, groups, 5, 0.8, "doc_id", "text").collect()}
    chained = {i for i, _ in chain} - brute_kept(chain)
    assert gone == {10 * n + i for i in range(7, n, 100)} | chained and len(chained) == 8
    assert len(rounds) <= 5


def test_recall_of_candidates():
    """Of texts with a similarity of about 0.8 and more, nearly all pairs are candidates, whatever their length."""
    rng = np.random.default_rng(8)
    found = total = 0
    for n in (30, 100, 400, 2000):
        for trial in range(60):
            words = [f"v{x}" for x in rng.integers(0, 5000, n)]
            other = list(words)
            for at in rng.integers(0, n, max(1, n // 60)):
                other[at] = f"new{trial}"
            texts = [" ".join(w).encode() for w in (words, other)]
            sets = [simhash._shingle_set(t, 5) for t in texts]
            if simhash._Sets(sets[:1]).similarity(sets[1])[0] >= 0.8:
                total += 1
                a, b = simhash._band_keys(texts, 5)
                fps = simhash._fingerprints(texts, 5, 42)
                found += bool((a == b).any() and (fps[0] ^ fps[1]).item().bit_count() <= simhash.CANDIDATE_RADIUS)
    assert total > 100 and found >= 0.95 * total


def test_long_texts_are_read_in_blocks(monkeypatch):
    text = ("one two three four five six " * 200 + "é " + "seven " * 90).encode()
    whole = simhash._fingerprints([text, b"a b"], 3, 42), simhash._band_keys([text, b"a b"], 5)
    for module in (simhash, textcore):
        monkeypatch.setattr(module, "CHUNK", 256)
    monkeypatch.setattr(simhash, "pieces", lambda t: textcore.pieces(t, 256))
    assert (simhash._fingerprints([text, b"a b"], 3, 42) == whole[0]).all()
    assert all((x == y).all() for x, y in zip(simhash._band_keys([text, b"a b"], 5), whole[1], strict=True))
    model = quality.Model(np.arange(1 << 16, dtype=np.float32) / 65536, np.arange(1 << 16, dtype=np.float32) / 65536, 0.5, 1.0, 0.0)
    want = quality.raw_scores(model, [text])
    monkeypatch.setattr(quality, "CHUNK", 256)
    monkeypatch.setattr(quality, "pieces", lambda t: textcore.pieces(t, 256))
    assert quality.raw_scores(model, [text]) == pytest.approx(want, rel=1e-5)


def thue_morse():
    """Two different words whose polynomial hashes modulo 2**64 are the same for every odd base."""
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_of_equal_polynomials_are_told_apart(spark):
    one, other = thue_morse()
    counts = quality.base_features([f"x y {one} x y {other}".encode()])
    assert counts["n_repeat_words"].tolist() == [0]
    rows = [(1, " ".join([f"w{i}" for i in range(49)] + [one])), (2, " ".join([f"w{i}" for i in range(49)] + [other]))]
    for size in (0, 1 << 18):
        assert substring_rows(spark.createDataFrame(rows, "doc_id long, text string"), group_bytes=size) == brute_repeats(rows)


def test_components_of_odd_graphs(spark, monkeypatch):
    rng = np.random.default_rng(9)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (330, 2))] + [(500, 500 + i) for i in range(1, 200)] + [(900, 700 + i) for i in range(100)]
    links = spark.createDataFrame(pairs, "a long, b long")
    root = {x: x for p in pairs for x in p}
    for _ in range(500):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    want = {x: r for x, r in root.items() if any(x in p and p[0] != p[1] for p in pairs)}
    for most in (100_000, 0):  # nodes in the middle broadcast, and salted
        monkeypatch.setattr(sys.modules["plumbline.llm.components"], "MIDDLE_ROWS", most)
        got = components(links).collect()
        assert {r.node: r.component for r in got} == want and len(got) == len(want)


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    assert components(links.where("a < 0")).count() == 0


def substring_rows(df, **more):
    return Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in substring.drop_repeats(df, **more).collect())


def test_substring_matches_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rng = np.random.default_rng(3)
    passage = [f"p{k}" for k in range(80)]
    for i in range(60):  # passages of about the window's length, at odd places, also at the edges
        lo, hi = sorted(rng.integers(0, 81, 2))
        rows.append((1000 + i, " ".join([f"u{i}{k}" for k in range(rng.integers(0, 30))] + passage[lo:hi] + [f"v{i}{k}" for k in range(rng.integers(0, 30))])))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_repeats(rows)
    assert sum(n for _, _, n, _ in want) > 1000
    assert substring_rows(table) == want
    assert substring_rows(table, group_bytes=3) == want  # every shared prefix is lengthened
    assert substring_rows(table, group_bytes=2000) == want  # some are


def test_substring_odd_rows(odd, none):
    assert substring_rows(odd) == brute_repeats([(i, t) for i, t, _ in ODD])
    passage = " ".join(f"p{i}" for i in range(70))
    rows = [(7, passage)] * 40 + [(i, f"in{i} {passage} out{i} {passage}") for i in range(5, 40)] + [(None, passage), (9, None), (7, "other " + passage)]
    rows += [(3, "again " * 300), (4, "again " * 200), (6, "more " + "again " * 120 + "end")]
    for size in (0, 1 << 18):
        assert substring_rows(odd.sparkSession.createDataFrame(rows, "doc_id long, text string").repartition(3), group_bytes=size) == brute_repeats(rows)
    assert substring.drop_repeats(none).count() == 0
    out = substring.strip_repeats(odd)
    assert out.schema == odd.schema and out.count() == len(ODD)
    assert sorted(r.text for r in out.where("doc_id = 2").collect()) == ["", ""]
    assert out.where("doc_id = 6").first().text == " \n\t "


def test_sharding_law(docs, odd, none):
    for df in (docs, odd):
        rows = sharding.shard(df).collect()
        assert len(rows) == df.count()
        by = defaultdict(list)
        for r in rows:
            by[r.shard].append(r.slot)
        counts = [len(by.get(s, [])) for s in range(16)]
        assert max(counts) - min(counts) <= 1
        assert all(sorted(x) == list(range(len(x))) for x in by.values())
        texts = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in df.collect())
        assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == texts
    assert sharding.shard(none).count() == 0


def test_sharding_moves_little(spark):
    df = spark.range(20000).selectExpr("id as doc_id", "cast(id as string) as text")
    a = {r.doc_id: (r.home, r.shard) for r in sharding.shard(df, 16).collect()}
    b = {r.doc_id: (r.home, r.shard) for r in sharding.shard(df, 17).collect()}
    assert all(b[i][0] in (a[i][0], 16) for i in a)  # homes only move to the new shard
    assert sum(a[i][1] != b[i][1] for i in a) < 0.12 * len(a)  # at best 1 in 17 moves
    assert sum(h == s for h, s in a.values()) > 0.8 * len(a)


def test_sharding_walks_the_ring(spark):
    """Rows by their rank in the cell: the home admits what it has room for, the rest goes on clockwise."""
    df = spark.createDataFrame([(i % 400, f"t{i % 400}") for i in range(1200)] + [(None, None)] * 300, "doc_id long, text string").withColumn("cell", F.lit("x"))
    rows = sharding.shard(df, 4, nodes=3, cells=64).collect()
    owner = sharding.ring(4, 3, 64).tolist()
    assert len(rows) == 1500 and all(r.home == owner[r.cell] for r in rows)
    for cell in range(64):  # of the first virtual node at or after the cell
        nodes = {xxhash.xxh64_intdigest(f"{s}/{k}", 17) % 64 for s in range(4) for k in range(3)}
        assert owner[cell] == owner[min(nodes, key=lambda n: (n - cell) % 64)]
    bound = 1500 // 4
    room = [bound + (s < 1500 % 4) for s in range(4)]
    cells = Counter(r.cell for r in rows)
    load = [Counter(), Counter()]
    over = []
    for cell in sorted(cells):
        own = min(cells[cell], room[owner[cell]])
        room[owner[cell]] -= own
        load[0][cell, owner[cell]] += own
        over.append((cell, cells[cell] - own))
    for cell, left in over:
        at = cell
        while left:
            at = (at + 1) % 64
            if owner[at] == owner[at - 1]:  # one stretch of a shard counts once
                continue
            took = min(left, room[owner[at]])
            room[owner[at]] -= took
            left -= took
            load[1][cell, owner[at]] += took
    assert Counter((r.cell, r.shard) for r in rows) == +(load[0] + load[1])
    for s in range(4):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(bound + (s < 1500 % 4)))

def test_packing_round_trip(docs, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    for df in (docs, odd):
        want = Counter()
        for r in df.collect():
            want[(r.doc_id, tuple([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]))] += 1
        pieces = packing.pack(df, queries.tokenizer_path(), group_docs=50).collect()
        sequences, parts = defaultdict(list), defaultdict(list)
        for p in pieces:
            ids = np.frombuffer(p.ids, "<u4").tolist()
            assert len(ids) == p.length and 0 < p.length <= 2048
            sequences[p.sequence_id].append((p.offset, p.length))
            parts[(p.doc_id, p.doc_tokens, p.start)].append(ids)
        for s in sequences.values():
            at = 0
            for offset, length in sorted(s):
                assert offset == at
                at += length
            assert at <= 2048
        assert sum(map(len, (x for p in parts.values() for x in p))) == sum(len(ids) * n for (_, ids), n in want.items())
        single = {k: v for k, v in want.items() if sum(n for (i, _), n in want.items() if i == k[0]) == 1}
        for doc, ids in single:
            got = [x for start in range(0, len(ids), 2048) for x in parts[(doc, len(ids), start)][0]]
            assert got == list(ids)


def test_packing_of_repeated_rows_and_other_tokenizers(spark, docs, none, monkeypatch):
    monkeypatch.setattr(packing, "REPEATED", 20)
    df = spark.createDataFrame([(1, "same words")] * 105 + [(None, None)] * 50 + [(2, "other")], "doc_id long, text string").withColumn("g", F.lit(1)).withColumn("length", F.lit("x"))
    rows = packing.pack(df, queries.tokenizer_path(), group_docs=10).collect()
    assert Counter(r.doc_id for r in rows) == {1: 105, None: 50, 2: 1}
    groups = Counter((r.doc_id, r.sequence_id >> 32) for r in rows)
    assert max(groups.values()) <= 60 and len({g for i, g in groups if i == 1}) > 2
    assert packing.pack(none, queries.tokenizer_path()).count() == 0
    monkeypatch.setattr(packing, "TASK_BYTES", 10)  # more tasks than the setting says
    assert Counter(r.doc_id for r in packing.pack(df, queries.tokenizer_path(), group_docs=10).collect()) == {1: 105, None: 50, 2: 1}
    from tokenizers import Tokenizer

    path = queries.tokenizer_path().replace("word_bpe_49k", "byte_bpe_50k")
    tokenizer = Tokenizer.from_file(path)
    few = docs.where("doc_id < 20")
    got = defaultdict(dict)
    for r in packing.pack(few, path, end_id=0).collect():
        got[r.doc_id][r.start] = np.frombuffer(r.ids, "<u4").tolist()
    for r in few.collect():
        assert [x for _, ids in sorted(got[r.doc_id].items()) for x in ids] == [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]


def test_first_fit_decreasing_is_first_fit():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 2049, 500)
    bins, offsets = packing.first_fit_decreasing(lengths, 2048)
    free = []
    for i in np.argsort(-lengths, kind="stable"):
        at = next((k for k, f in enumerate(free) if f >= lengths[i]), len(free))
        if at == len(free):
            free.append(2048)
        assert (bins[i], offsets[i]) == (at, 2048 - free[at])
        free[at] -= lengths[i]


def test_tokens_of_words_are_tokens_of_texts():
    ids = packing.tokens_of(queries.tokenizer_path())
    for text in ["It's  a\u00a0test\x1cwith\x85odd \u0301space <|endoftext|> x<|startoftext|>y ÉÀ ΑΣ Σ. don'T 'S 12,5 日本語\u3000text", "e\u0301 a\r\n\tb", "'  s", "x" * 5000]:
        want = ids.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids.text(text.encode()), "<u4").tolist() == want


def reference_adpcm(block):
    value, index, out = int.from_bytes(block[:2], "little", signed=True), block[2], []
    out.append(value)
    for code in (c for b in block[4:] for c in (b & 15, b >> 4)):
        step = int(media.STEPS[index])
        change = (step >> 3) + (step if code & 4 else 0) + (step >> 1 if code & 2 else 0) + (step >> 2 if code & 1 else 0)
        value = max(-32768, min(32767, value - change if code & 8 else value + change))
        index = max(0, min(88, index + int(media.MOVES[code & 7])))
        out.append(value)
    return out


def test_media_round_trip(odd, none):
    stored = media.encode_texts(odd)
    for r in media.decode(stored).collect():
        assert r.payload[: r.n_bytes].strip(b" ") == r.payload.strip(b" ") and len(r.payload) % 192 == 0 and len(r.payload) >= 192
        codec, rate, _, _ = media.read_wav(bytes(r.media))
        assert codec == r.codec and rate == 8000 and len(r.pcm) % 2 == 0
    assert media.decode(media.encode_texts(none)).count() == 0
    got = Counter((r.doc_id, bytes(r.payload)) for r in media.decode(stored).collect())
    pad = lambda t: t.ljust(max(192, -(-len(t) // 192) * 192))
    assert got == Counter((i, pad((t or "").encode())) for i, t, _ in ODD)


def brute_sound(codec, media):
    """PCM at 16000 from a WAV file at 8000, sample by sample, and its feature."""
    data = media[media.index(b"data") + 8 :]
    if codec == "ima_adpcm":
        pcm = [x for lo in range(0, len(data), media_block) for x in reference_adpcm(data[lo : lo + media_block])]
    else:
        pcm = [int(media_tables[codec][c]) for c in data]
    double = [x for a, b in zip(pcm, [*pcm[1:], pcm[-1]], strict=True) for x in (a, (a + b) // 2)]
    raw = np.array(double, "<i2").tobytes()
    crossings = sum((a < 0) != (b < 0) for a, b in zip(double, double[1:], strict=False))
    rms = int((sum(x * x for x in double) // len(double)) ** 0.5)
    return raw, f"{codec};rate=16000;samples={len(double)};peak={max(map(abs, double))};rms={rms};crossings={crossings};crc={zlib.crc32(raw):08x}"


media_block, media_tables = media.BLOCK + 4, media.TABLES


def test_media_query_against_brute_force(spark, sf, docs, monkeypatch):
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    rows = {r.doc_id: r for r in queries.op8_media(spark, sf).collect()}
    files = {r.doc_id: bytes(r.media) for r in media.encode_texts(docs).collect()}
    assert rows.keys() == texts.keys()
    for i, t in texts.items():
        payload = t.ljust(max(192, -(-len(t) // 192) * 192))
        r, codec = rows[i], media.read_wav(files[i])[0]
        assert (r.n_bytes, r.payload_bytes, r.media_bytes) == (len(t), len(payload), len(files[i]))
        assert (r.payload_sha256, r.media_sha256, r.tail_crc32) == (hashlib.sha256(payload).hexdigest(), hashlib.sha256(files[i]).hexdigest(), zlib.crc32(payload[-16:]))
        if len(t) < 3000:
            raw, feature = brute_sound(codec, files[i])
            assert (r.pcm_bytes, r.pcm_crc32, r.feature) == (len(raw), zlib.crc32(raw), feature)
    some = sorted(files)[:40]
    whole = media._decode([files[i] for i in some], 16000, True)
    monkeypatch.setattr(media, "AT_ONCE", 500)  # every longer file in parts
    assert media._decode([files[i] for i in some], 16000, True) == whole
    rng = np.random.default_rng(6)
    sound = rng.integers(-32768, 32767, 1000).astype("<i2")
    for rate, to in ((8000, 16000), (8000, 8000), (11025, 16000), (16000, 8000), (8000, 44100)):
        want = [(int(sound[k * rate // to]) * (to - k * rate % to) + int(sound[min(999, k * rate // to + 1)]) * (k * rate % to)) // to for k in range(1000 * to // rate)]
        assert media.resample(sound, rate, to).tolist() == want
        for cuts in ([1], [3, 500], [999]):
            assert np.concatenate(list(media.resampled(np.split(sound, cuts), rate, to))).tolist() == want
    with pytest.raises(ValueError, match="blocks of 0 bytes"):
        media._decode([files_without_blocks()], 16000, True)


def files_without_blocks():
    whole = bytearray(media.wav("ima_adpcm", b" " * 192))
    at = whole.index(b"fmt ") + 8 + 12
    whole[at : at + 2] = b"\0\0"
    return bytes(whole)


def test_media_decoders():
    rng = np.random.default_rng(2)
    blocks = rng.integers(0, 256, (20, 60), dtype=np.uint8)
    blocks[:, 2] %= 89
    assert media.decode_blocks(blocks).tolist() == [reference_adpcm(bytes(b)) for b in blocks]
    assert media.TABLES["mulaw"][[0, 127, 128, 255, 0x8F]].tolist() == [-32124, 0, 32124, 0, 16764]
    assert media.TABLES["alaw"][[0x55, 0xD5, 0x2A, 0xAA, 0]].tolist() == [-8, 8, -32256, 32256, -5504]
    assert media.resample(np.array([0, 10, -10], "<i2"), 8000, 16000).tolist() == [0, 5, 10, 0, -10, -10]
    assert media.resample(np.arange(12, dtype="<i2"), 12000, 8000).tolist() == [0, 1, 3, 4, 6, 7, 9, 10]
    with pytest.raises(ValueError):
        media.read_wav(b"nothing")


def test_quality_base_features(spark, sf, docs, odd, none):
    model = quality.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    for df in (docs, odd):
        got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.judge(df, model).collect())
        assert got == Counter((r.doc_id, *brute_base(r.text)) for r in df.collect())
    kept = quality.judge(docs, model).where("kept").count()
    assert quality.keep_good(docs, model).count() == kept and quality.keep_good(odd, model).schema == odd.schema
    assert quality.judge(none, model).count() == 0
    nothing = quality.train(odd, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert quality.judge(odd, nothing).where("kept = base_failed").count() == 0


def test_calibration():
    """Of classes that overlap, shares are met; of classes told apart, probabilities stay short of certainty."""
    rng = np.random.default_rng(3)
    y = (rng.random(4000) < 0.3).astype(float)
    z = rng.normal(np.where(y == 1, 40.0, -10.0), 30.0)
    a, b = quality.calibrate(z, y, np.ones(4000))
    p = 1 / (1 + np.exp(-(a * z + b)))
    for lo in (0.1, 0.3, 0.5, 0.7):
        near = (p >= lo) & (p < lo + 0.2)
        assert near.sum() > 100 and abs(y[near].mean() - p[near].mean()) < 0.06
    apart = np.where(np.arange(100) < 40, 50.0, -50.0)
    a, b = quality.calibrate(apart, (apart > 0).astype(float), np.ones(100))
    p = 1 / (1 + np.exp(-(a * apart + b)))
    assert p[0] == pytest.approx(41 / 42, abs=1e-4) and p[-1] == pytest.approx(1 / 62, abs=1e-4)


def test_quality_probabilities_by_hand(spark, sf, docs, odd):
    """Scores against plain loops over words, pairs of words and runs of characters; verdicts against the threshold."""
    model = quality.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    most = 1 << 64

    def mixed(h):
        return int(textcore.mix(np.array([h % most], dtype=np.uint64))[0])

    def probability(text):
        data = (text or "").encode()
        hashes = [int(textcore.word_hashes([w])[0][0]) for w in data.split()]
        words = [h >> 48 for h in hashes] + [mixed(a * 3 + b) >> 48 for a, b in zip(hashes, hashes[1:], strict=False)]
        points = [ord(c) for c in text or ""]

        def gram(own):
            h = len(own)
            for c in own:
                h = (h * 0xD6E8FEB86659FD93 + c) % most
            return (h * 0x9E3779B97F4A7C15 % most) >> 48

        chars = [gram(points[i : i + n]) for n in (3, 4) for i in range(len(points) - n + 1)]
        z = model.bias + sum(30.0 * sum(float(w[k]) for k in at) / max(1, len(at)) for w, at in ((model.words, words), (model.chars, chars)))
        return 1 / (1 + np.exp(-(model.slope * z + model.shift)))

    rows = docs.where("n_chars < 4000").select("doc_id", "text").union(odd.where("doc_id <> 8 or doc_id is null").select("doc_id", "text"))
    texts = {(r.doc_id, r.text) for r in rows.collect()}
    want = Counter((i, round(float(probability(t)), 4)) for i, t in texts)
    got = quality.judge(rows.distinct(), model).collect()
    assert Counter((r.doc_id, round(r.probability, 4)) for r in got).keys() <= want.keys() | {(i, round(p + d, 4)) for i, p in want for d in (1e-4, -1e-4)}
    assert all(r.kept == (not r.base_failed and r.probability >= quality.KEEP) for r in got) and len(got) == len(texts)


def test_quality_on_labels_not_seen(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    seen = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = quality.train(docs, labels.where(seen), per_class=300)
    test = quality.judge(docs, model).join(labels.where(~seen), "doc_id").where("not base_failed")
    rates = {r.quality: r.kept for r in test.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert rates[1] > 0.95 and rates[0] < 0.4


def test_toxicity_on_labels_not_seen(spark, odd, none):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    seen = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = toxicity.train(docs, labels.where(seen))
    assert (np.diff(model.thresholds) >= 0).all() and len(model.keys) < 1000
    flags = toxicity.grade(docs, model).withColumnRenamed("toxic", "flag").join(labels.where(~seen), "doc_id")
    table = {(r.toxic, r.flag): r["count"] for r in flags.groupBy("toxic", "flag").count().collect()}
    assert table.get((0, True), 0) <= 0.01 * table[(0, False)]
    assert table[(1, True)] >= 0.88 * (table[(1, True)] + table[(1, False)])
    assert toxicity.grade(odd, model).count() == len(ODD) and toxicity.grade(none, model).count() == 0
    assert toxicity.grade(odd, toxicity.train(odd, labels.where("doc_id < 0"))).where("toxic").count() == 0


def test_toxicity_scores_and_severity(spark):
    """Grades follow how much is toxic, though labels do not say it; scores are held against a sum by hand."""
    rng = np.random.default_rng(11)
    bad = [f"vile{i}" for i in range(30)]
    rows, planted, labels = [], {}, []
    for i in range(900):
        words = [f"word{x}" for x in rng.integers(0, 300, 60)]
        planted[i] = (0, 0, 2, 8, 25)[i % 5]
        for at in rng.choice(60, planted[i], replace=False):
            words[at] = bad[rng.integers(30)]
        rows.append((i, " ".join(words)))
        if i < 600:
            labels.append((i, int(planted[i] > 0)))
    rows += rows[:50] + [(5, "another text of a labelled id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("y", F.lit("clash")).withColumn("toxic", F.lit(1))
    marked = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(df, marked)
    again = toxicity.train(df.repartition(7), marked.repartition(2))
    assert (again.keys == model.keys).all() and (again.weights == model.weights).all()
    got = {r.doc_id: r for r in toxicity.grade(df.where("doc_id >= 600"), model).collect()}
    mean = {n: np.mean([r.expected_severity for i, r in got.items() if planted[i] == n]) for n in (0, 2, 8, 25)}
    assert mean[0] < 0.2 and all(mean[b] > mean[a] + 0.2 for a, b in ((0, 2), (2, 8), (8, 25)))
    weights = dict(zip(model.keys.tolist(), model.weights.tolist(), strict=True))
    for i, r in got.items():
        text = dict(rows)[i].encode()
        times = Counter()
        for w in text.split():
            word = textcore.word_hashes([w])[0]
            times[int(word[0])] += 1
            if len(w) > 6:
                times[int(textcore.mix(textcore.word_hashes([w[:6]])[0] + np.uint64(6))[0])] += 1
        score = sum(weights.get(k, 0) * np.log(1 + n) for k, n in times.items())
        above = [1 / (1 + np.exp(t - score)) for t in model.thresholds]
        each = [a - b for a, b in zip([1, *above], [*above, 0], strict=True)]
        assert r.expected_severity == pytest.approx(sum(k * p for k, p in enumerate(each)), abs=1e-5)
        assert r.p_toxic == pytest.approx(above[0], abs=1e-5) and r.toxic == (above[0] >= 0.5) and each[r.severity] == pytest.approx(max(each))


def test_mixing(spark, docs, odd, none):
    rng = np.random.default_rng(4)
    skewed = spark.createDataFrame(
        [(i, " ".join(["w"] * int(rng.integers(0, 200))), f"s{min(9, int(rng.exponential(2)))}" if i % 11 else None) for i in range(1500)], "doc_id long, text string, source string"
    )
    text = "w " * 10
    repeated = spark.createDataFrame(
        [*[(1, text, "a", i % 7) for i in range(1000)], *[(i, text, s, 0) for s in "bc" for i in range(1000)], *[(5, text, None, i) for i in range(50)]], "doc_id long, text string, source string, own int"
    )
    for df in (docs, skewed, odd, repeated, repeated.where("source = 'a'")):
        rows = mixing.mix(df).collect()
        sizes = Counter()
        for r in df.collect():
            sizes[r.source] += len(WORD.findall(r.text or ""))
        want = brute_targets(sizes)
        taken, biggest = Counter(), Counter()
        assert len(rows) == df.count()
        for r in rows:
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
            assert r.taken == r.copies * r["size"] and r.copies <= 3
            taken[r.source] += r.taken
            biggest[r.source] = max(biggest[r.source], r["size"])
        assert all(abs(taken[s] - want[s]) <= biggest[s] for s in sizes)
        assert Counter(map(tuple, rows)) == Counter(map(tuple, mixing.mix(df.repartition(3)).collect()))
        mixed = mixing.apply_mix(df)
        assert mixed.schema == df.schema
        again = Counter()
        for r in mixed.collect():
            again[r.source] += len(WORD.findall(r.text or ""))
        assert +again == +taken
        assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.apply_mix(df.repartition(3)).collect()))
    assert mixing.mix(none).count() == 0 and mixing.apply_mix(none).count() == 0


def test_urls(spark, sf, monkeypatch):
    many = [
        None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://A.Example.NET/en/x?y#z", "https://example.netx/en/", "x://notexample.net/en/", "http://example.com/de", "a://b://c.org/fr/",
        "http://c.org/fr/?q", "http://c.org#/fr/", "http://example.com/de/" + "x" * 20000, "http://ß.Ä.net/é", "http://..net/", "http://a..net/",
    ]
    odd = spark.createDataFrame([(i if i % 5 else None, u) for i, u in enumerate(many * 2)], "page_id long, url string").withColumn("key", F.lit(1)).withColumn("host", F.lit("x"))
    dots = spark.createDataFrame([(1, "http://" + "a." * 50000 + "example.net/en/"), (2, "http://" + "." * 20000 + "org/fr/"), (3, "http://net" + "." * 20000)], "page_id long, url string")
    for df in (odd, dots, spark.read.parquet(f"{sf}/pages.parquet")):
        want = Counter((r.page_id, *brute_url(r.url, urls.RULES, "allow")) for r in df.collect())
        for bits, shapes in ((urls.MOST_BITS, urls.SHAPES), (64, urls.SHAPES), (urls.MOST_BITS, 0)):  # whole, in parts, and by host first
            monkeypatch.setattr(urls, "MOST_BITS", bits)
            monkeypatch.setattr(urls, "SHAPES", shapes)
            assert Counter(map(tuple, urls.filter_urls(df).collect())) == want
        monkeypatch.undo()
    with pytest.raises(ValueError):
        urls.filter_urls(odd, (("allow", "net", "/"), ("block", "net", "/")))
    assert urls.filter_urls(odd, ()).where("verdict <> 'allow' or rule is not null").count() == 0
    assert urls.filter_urls(odd.where("page_id = -1")).count() == 0


def test_cascade_is_exact(spark):
    universe = spark.range(3000).selectExpr("concat('k', id) as key")
    for listed in (universe.where("pmod(xxhash64(key), 5) = 0"), universe.where("key = 'k7'"), universe.where("key = ''"), universe):
        cascade = urls.build(listed, universe)
        got = {r.key for r in universe.select("key", *cascade.columns("w")).where(cascade.contains("w")(F.col("key"))).collect()}
        assert got == {r.key for r in listed.collect()}
    assert len(urls.build(universe.where("pmod(xxhash64(key), 5) = 0"), universe).levels) > 2


def test_a_long_list(spark):
    """Each of 100,000 listed keys and no other is found, of whatever table the rules come from."""
    listed = spark.range(100_000).selectExpr("'block' as action", "concat('h', id, '.net') as host", "'/' as path")
    pages = spark.range(0, 200_000, 7).selectExpr("id as page_id", "concat('http://www.h', id, '.net/x') as url")
    got = urls.filter_urls(pages, listed).agg(F.sum(F.expr("cast((verdict = 'block') <> (page_id < 100000) as int)")).alias("wrong"), F.count("rule").alias("rules")).first()
    assert got.wrong == 0 and got.rules == len(range(0, 100_000, 7))


def test_lists_in_parts_are_exact(spark, monkeypatch):
    monkeypatch.setattr(urls, "MOST_BITS", 2048)
    universe = spark.range(3000).selectExpr("concat('k', id) as key")
    listed = universe.where("pmod(xxhash64(key), 5) = 0")
    cascade = urls.build(listed, universe)
    assert isinstance(cascade, urls.Parts)
    got = {r.key for r in universe.select("key", *cascade.columns("w")).where(cascade.contains("w")(F.col("key"))).collect()}
    assert got == {r.key for r in listed.collect()}
    plan = urls.filter_urls(spark.range(9).selectExpr("id as page_id", "'http://a.net/' as url"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_a_list_of_many_shapes(spark):
    """Rules with 300 lengths of paths and hosts of one to ten labels, against the rules one by one."""
    rules = [("block" if i % 2 else "allow", ".".join(f"l{i % 7}" for _ in range(i % 10 + 1)) + f".h{i % 40}", "/" + "p" * (i % 300)) for i in range(1500)]
    rules = list({(h, p): (a, h, p) for a, h, p in rules}.values())
    pages = [(i, f"http://www.{rules[i * 7 % len(rules)][1]}/{'p' * (i * 13 % 320)}{'' if i % 3 else '/x'}?q") for i in range(400)] + [(None, None), (1, "http://h1/ppp")]
    df = spark.createDataFrame(pages, "page_id long, url string")
    assert Counter(map(tuple, urls.filter_urls(df, tuple(rules)).collect())) == Counter((i, *brute_url(u, rules, "allow")) for i, u in pages)


def test_the_whole_unlicense(spark):
    whole = licences.TEXTS["Unlicense"]
    start = whole[: whole.index(" In jurisdictions")]
    df = spark.createDataFrame([(1, whole.replace(". ", ".\n\n")), (2, start)], "doc_id long, text string")
    assert "IN NO EVENT SHALL" in whole and whole.endswith("<https://unlicense.org/>")
    assert {r.doc_id: r.licence for r in licences.scan(df).collect()} == {1: "Unlicense", 2: None}


def test_short_licences_that_others_begin_like(spark):
    """Each known text is itself and no other, in its usual file; half of it is none."""
    rows = [(f"{n} {way}", t) for n, text in licences.TEXTS.items() for way, t in (
        ("bare", text), ("file", f"{licences.TITLES[n][0]}\n\nCopyright (c) 2020 A. Person\n\n{text}\n"), ("wrapped", "\n".join("// " + " ".join(text.split()[i : i + 9]) for i in range(0, len(text.split()), 9))),
        ("half", text[: len(text) // 2]))]
    got = {r.doc_id: r.licence for r in licences.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert {"MIT-0", "0BSD", "BSL-1.0"} <= set(licences.TEXTS)
    assert got == {k: None if k.endswith("half") else k.split(" ")[0] for k, _ in rows}


#: Where a system has them, the texts that the digests are of.
COMMON = Path("/usr/share/common-licenses")


@pytest.mark.skipif(not COMMON.is_dir(), reason="no licence texts here")
def test_whole_licences(spark):
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0-only", "GPL-3": "GPL-3.0-only", "LGPL-2.1": "LGPL-2.1-only", "LGPL-3": "LGPL-3.0-only", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    texts = {f: (COMMON / f).read_text() for f in names if (COMMON / f).is_file()}
    rows = [(f"{f} {way}", t) for f, whole in texts.items() for way, t in (("plain", whole), ("loud", whole.upper()), ("spread", whole.replace("\n", " \n\n\t")), ("more", whole + " with a word"), ("less", whole[: len(whole) // 2]))]
    rows += [("MIT titled", "The MIT License (MIT)\n\nCopyright (c) 2021 Someone\n\n" + licences.TEXTS["MIT"]), ("BSD-3", "BSD 3-Clause License\n(c) 2019 X\nAll rights reserved.\n" + licences.TEXTS["BSD-3-Clause"])]
    rows += rows[:2]  # repeated rows
    got = Counter((r.doc_id, r.licence) for r in licences.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect())
    want = Counter((f"{f} {way}", names[f] if way in ("plain", "loud", "spread") else None) for f in texts for way in ("plain", "loud", "spread", "more", "less"))
    want += Counter({("MIT titled", "MIT"): 1, ("BSD-3", "BSD-3-Clause"): 1})
    want += Counter((k, names[k.split(" ")[0]]) for k, _ in rows[:2])
    assert got == want


def test_licences_that_name_their_holder(spark):
    """Whole files with owners in other forms than a year or sign, and holders inside clauses; texts that only look like it stay unknown."""
    bsd, mit = licences.TEXTS["BSD-3-Clause"], licences.TEXTS["MIT"]
    named = bsd.replace("the copyright holder nor", "the University of Somewhere, Inc. nor").replace("BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "BY THE REGENTS AND CONTRIBUTORS").replace("THE COPYRIGHT HOLDER OR CONTRIBUTORS", "THE REGENTS OR CONTRIBUTORS")
    wrapped = "\n".join(" ".join(bsd.split()[i : i + 9]) for i in range(0, len(bsd.split()), 9))
    rows = [
        (1, "MIT License\n\nCopyright A. Person\n\n" + mit), (2, "Copyright The Project Authors\n\n" + mit), (3, "Copyright 2001-2004 X\nAll rights reserved.\n\n" + named), (4, named), (5, wrapped),
        (6, mit.replace("Permission", "Copyright A. Person\nPermission", 1)), (7, named.replace("prior written permission", "permission")), (8, "Copyright A. Person\n\n"),
    ]
    got = {r.doc_id: r.licence for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: "BSD-3-Clause", 4: "BSD-3-Clause", 5: "BSD-3-Clause", 6: None, 7: None, 8: None}


def test_licences(spark, docs, none):
    mit = licences.TEXTS["MIT"]
    odd = [
        (1, "Copyright (c) 2020 A. Person\n\n" + mit.replace(". ", ".\n")), (2, mit.upper().replace("SUBLICENSE", "sub-licence")), (3, mit + " more"), (4, None), (5, ""),
        (6, "text\n  released under the MIT licence\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License"), (7, "Licensed under the Apache License, v2.0"), (None, "© 2001\nSPDX-License-Identifier: MIT"), (8, "word " * 50000),
    ]
    df = spark.createDataFrame(odd, "doc_id long, text string").withColumn("digest", F.lit(1))
    got = {r.doc_id: r for r in licences.scan(df).collect()}
    assert [got[k].licence for k in (1, 2, 3, 4, 5, 6, None, 8)] == ["MIT", "MIT", None, None, None, None, "MIT", None]
    assert got[6].notices == ["CC-BY-NC-4.0", "MIT"] and got[6].n_notice_lines == 3 and got[4].digest is None
    for i, t in odd:
        assert t is None or got[i].digest == hashlib.sha256(licences.canonical(t).encode()).hexdigest()
    assert {r.doc_id: r.digest for r in licences.scan(docs).collect()} == {r.doc_id: hashlib.sha256(licences.canonical(r.text).encode()).hexdigest() for r in docs.collect()}
    assert licences.scan(none).count() == 0
