"""The operators for training data against brute force, round trips and odd rows."""

from __future__ import annotations

import itertools
import math
import os
import random
import re
import tempfile
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabveil.llm import decontamination, license_scan, line_dedup, minhash_dedup, piece_sampling, quality_rules
from tabveil.llm import secret_ledger, token_counts, token_frames, warc
from tabveil.llm.pieces import Vocabulary
from tabveil.llm.queries import QUERIES, tokenizer_file

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, words string"
ODD = [
    (1, "a b c d e f g h i j k l", "en", "s", 1, "x", "y", "z"),
    (1, "a b c d e f g h i j k l", "en", "s", 1, "x", "y", "z"),
    (2, "A b c d e f g h i j k l\n\nA b c d e f g h i j k l", None, None, None, None, None, None),
    (3, None, "en", "s", 0, "x", "y", "z"), (4, "", "en", "s", 0, "x", "y", "z"), (5, " \n\t", "en", "s", 0, "x", "y", "z"),
    (None, "a b c d e f g h i j k m", "en", "s", 0, "x", "y", "z"),
    (6, "▁ x  y\u0001 \U0001f600 ﬁ é\r\n" * 3000, "en", "s", 0, "x", "y", "z"),
    (6, "another text of the same id", "en", "s", 0, "x", "y", "z"),
    (7, "one", "de", "s", 0, "x", "y", "z"), (8, "one", "de", "s", 0, "x", "y", "z"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def corpus(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="module")
def pieces():
    return tokenizer_file("piece_bpe_32k.model")


def shared_folder():
    return "file://" + tempfile.mkdtemp(prefix="llm-test-")


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, size):
    w = words(text)
    size = min(size, len(w))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()


def test_shards_hold_whole_texts_in_order(spark, odd, corpus):
    from tokenizers import Tokenizer

    model = tokenizer_file("word_bpe_49k.json")
    whole = Tokenizer.from_buffer(model)
    for docs in (odd, corpus.select("doc_id", "text")):
        manifest = token_frames.write_shards(docs, shared_folder(), model, 2, frame_ids=64)
        got = sorted(token_frames.read_shards(manifest).collect(), key=lambda r: r["start"])
        rows = docs.select("doc_id", "text").collect()
        assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in rows), key=lambda k: (k is not None, k))
        want = Counter()
        for r in rows:
            ids = whole.encode(r["text"] or "", add_special_tokens=False).ids + [2]
            want[r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
        assert [r["start"] for r in got] == [0, *itertools.accumulate(r["n_tokens"] for r in got)][:-1]
    one = token_frames.read_ids(manifest, spark.createDataFrame([(5,)], "doc_id long")).collect()
    text = corpus.where("doc_id = 5").first()["text"]
    assert [r["ids"] for r in one] == [whole.encode(text, add_special_tokens=False).ids + [2]]


def test_encoder_looks_words_up_once_a_batch():
    import pyarrow as pa
    from tokenizers import Tokenizer

    class Counted(dict):
        looked_up = 0

        def __getitem__(self, key):
            self.looked_up += 1
            return super().__getitem__(key)

    model = tokenizer_file("word_bpe_49k.json")
    whole, encoder = Tokenizer.from_buffer(model), token_frames.Encoder(model, 2)
    texts = ["", " ", "a", " Été, Straße; x  y\n", "\x0b\x1c\x85\u2028 İx ΑΣ, 日本 a1 #", "...", "same word " * 500, None, "\r\n a"]
    encoder.words = Counted(encoder.words)
    got = encoder.encode(pa.array([None, "cut", *[t or "" for t in texts]]).slice(2))
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids + [2]
    # Two parts for each of about twenty chunks, not one for each of more than a thousand words.
    assert 0 < encoder.words.looked_up < 100
    assert encoder.encode(pa.array([""])) == [b"\2\0\0\0"] and encoder.encode(pa.array([], pa.string())) == []


def test_damaged_frame_is_found(tmp_path):
    path = tmp_path / "shard"
    with path.open("wb") as out:
        writer = token_frames.ShardWriter(out, 8)
        writer.add(3, np.arange(50, dtype="<u4").tobytes())
        writer.close()
    data = bytearray(path.read_bytes())
    data[20] ^= 1
    path.write_bytes(data)
    with path.open("rb") as file, pytest.raises(Exception):
        token_frames.ShardReader(file, len(data)).document(0)


def brute_components(rows, size):
    sets = [(k, shingles(t, size)) for k, t in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(sets)), 2):
        a, b = sets[i][1], sets[j][1]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            parent[root(i)] = root(j)
    low = {}
    for i, (k, s) in enumerate(sets):
        if k is not None:
            low[root(i)] = min(low.get(root(i), k), k)
    return Counter((k, len(s), low.get(root(i)) if s else k) for i, (k, s) in enumerate(sets))


@pytest.mark.parametrize("size", [2, 5])
def test_near_copies_equal_all_pairs(odd, corpus, size):
    base = corpus.select("doc_id", "text")
    # A chain of variants: neighbours are alike, the ends aren't.
    chain = [(1000 + i, " ".join(f"w{j}" for j in range(4 * i, 4 * i + 100))) for i in range(30)]
    for docs in (odd.select("doc_id", "text"), base.union(base.sparkSession.createDataFrame(chain, "doc_id long, text string"))):
        rows = [tuple(r) for r in docs.collect()]
        got = minhash_dedup.near_copies(docs, size=size).collect()
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_components(rows, size)
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_one_document_of_a_group_stays(odd):
    left = minhash_dedup.drop_near_copies(odd)
    assert left.columns == odd.columns
    assert Counter(r["doc_id"] for r in left.collect()) == {None: 1, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 2, 7: 1}


def brute_lines(rows):
    lines = sorted(
        (k if k is not None else -math.inf, i, frozenset(re.split(r"[\x20\x09-\x0D]+", x.lower())) - {""})
        for k, t in rows for i, x in enumerate((t or "").split("\n"))
    )
    lines = [x for x in lines if x[2]]
    gone = set()
    for n, (k, i, a) in enumerate(lines):
        if any((k2, i2) < (k, i) and 5 * len(a & b) >= 4 * len(a | b) for k2, i2, b in lines[:n]):
            gone.add((k, i))
    return gone


def test_lines_equal_all_pairs(odd, corpus):
    some = corpus.where("doc_id < 60").select("doc_id", "text")
    variants = [(2000 + i, " ".join(f"w{j}" for j in range(2 * i, 2 * i + 40)) + f"\nrare{i} line") for i in range(25)]
    for docs in (odd, some.union(some.sparkSession.createDataFrame(variants, "doc_id long, text string"))):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        got = {(r["key"] if r["key"] != line_dedup.LOW else -math.inf, r["line"]) for r in line_dedup.later_lines(docs).collect()}
        assert got == brute_lines(rows)
    left = line_dedup.drop_lines(odd)
    assert left.columns == odd.columns and left.where("doc_id in (3, 4, 5)").count() == 3


def test_long_lines_that_share_rare_words_are_no_candidates(spark):
    """Lists of a rare word hold long lines that share little else: their signatures have to tell them apart."""
    made = random.Random(5)
    texts = [" ".join(["rare", *made.sample([f"v{j}" for j in range(600)], 180)]) for _ in range(60)]
    near = texts[0].replace("rare", "other words")
    docs = spark.createDataFrame(list(enumerate([*texts, near])), "doc_id long, text string")
    ranks = line_dedup.rarity(docs, "text")
    table = line_dedup.line_table(line_dedup.distinct_rows(docs, "doc_id", "text"), ranks)
    lines = table.withColumn("low", F.col("both").bitwiseXOR(F.col("high")))
    done = lines.where("false").select(*line_dedup.LINE)
    met = line_dedup.all_candidates(lines, done)
    pairs = {(r["key0"], r["key"]) for r in met.collect()}
    # 64 bits let 1,810 of the 1,830 pairs pass.
    assert (0, 60) in pairs and len(pairs) < 90


def test_lines_with_any_separators_have_sorted_distinct_tokens(spark):
    """A line of one blank between words is split without a pattern; tokens are sorted where that is compiled, not inside a lambda."""
    texts = ["a b c", "c\tb a", " a  b\x0bc \r", "c b\x0ca a b", "a\x85b c", "a b\u2003c", "\t", "a\tb", "A B C", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ranks = line_dedup.rarity(docs, "text")
    table = line_dedup.line_table(line_dedup.distinct_rows(docs, "doc_id", "text"), ranks)
    made = {r["key"]: (r["n"], r["s1"]) for r in table.collect()}
    sets = {i: set(words((t or "").lower())) for i, t in enumerate(texts)}
    assert made.keys() == {i for i, x in sets.items() if x} and all(made[i][0] == len(sets[i]) for i in made)
    assert all((made[i][1] == made[j][1]) == (sets[i] == sets[j]) for i in made for j in made)
    assert "array(sort_array" not in table._jdf.queryExecution().optimizedPlan().toString()
    t = docs.select(line_dedup.tokens(F.lit(" ".join(f"w{i % 40}" for i in range(80))), ranks).alias("t")).first()["t"]
    assert t == sorted(t) and len(t) == 40


def test_lines_of_documents_that_share_an_id(spark):
    """Each row has a place of its own: different texts with one id or none, and equal rows."""
    same = "one two three four five six seven eight nine ten"
    texts = [f"alpha{i} beta{i} gamma{i} delta{i} eps{i}\n{same}\nonly here {i} and nowhere else {i * i}" for i in range(4)]
    texts += [f"{same}\n\nx{i} y{i} z{i} w{i} v{i}" for i in range(2)] + [texts[0], texts[0], same + " eleven", None, ""]
    for ids in ([7] * len(texts), [None] * len(texts), [7, None, 3] * 4):
        docs = spark.createDataFrame([(k, t) for k, t in zip(ids, texts)], "doc_id long, text string")
        rows = docs.select(line_dedup.place("doc_id").alias("k"), line_dedup.mark("text").alias("m"), "text").collect()
        rows = sorted((r["k"], r["m"], r["text"] or "") for r in rows)
        seen, want = [], []
        for k, m, t in rows:
            rest = []
            for x in t.split("\n"):
                a = set(words(x))
                if not a or not any(5 * len(a & b) >= 4 * len(a | b) for b in seen):
                    rest.append(x)
                if a:
                    seen.append(a)
            n = len(t.split("\n"))
            want.append((k, n, n - len(rest), "\n".join(rest), len(rest) < n and not "".join(rest).strip()))
        made = line_dedup.without_lines(docs, line_dedup.later_lines(docs)).collect()
        got = [(line_dedup.LOW if r["row"]["doc_id"] is None else r["row"]["doc_id"], *r[1:]) for r in made]
        assert Counter(got) == Counter(want)
        left = line_dedup.drop_lines(docs).collect()
        assert Counter(r["text"] or "" for r in left) == Counter(t for _, _, _, t, emptied in want if not emptied)


def test_pieces_are_counted_as_the_unigram_tokenizer_does(spark, odd, corpus, pieces):
    import sentencepiece
    from tokenizers import Tokenizer, models, pre_tokenizers

    sp = sentencepiece.SentencePieceProcessor(model_proto=pieces)
    vocabulary = [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]
    unigram = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    unigram.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=False)
    texts = [r["text"] for r in corpus.where("doc_id < 40").collect()] + ["  two  blanks ", "日本 \U0001f600 x", "line\nend", "a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs, pieces).collect()}
    for i, t in enumerate(texts):
        first, *lines = t.split("\n")
        # A blank is put before the text alone; a line end is one byte.
        want = len(unigram.encode(first).ids) + sum(1 + count_plain(unigram, x) for x in lines)
        assert got[i] == want, t[:80]
    assert token_counts.count_tokens(odd, pieces).count() == len(ODD)


def count_plain(unigram, line):
    """Pieces of a line that has no blank put before it."""
    from tokenizers import pre_tokenizers

    before = unigram.pre_tokenizer
    unigram.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="never", split=False)
    n = len(unigram.encode(line).ids) if line else 0
    unigram.pre_tokenizer = before
    return n


def test_sampling_is_lossless_and_repeatable(odd, corpus, pieces):
    import sentencepiece

    for docs in (odd, corpus.limit(50).select("doc_id", "text")):
        one = piece_sampling.sample_pieces(docs, pieces, keep=("doc_id", "text"))
        got = one.collect()
        assert all(r["decoded"] == (r["text"] or "") for r in got)
        two = piece_sampling.sample_pieces(docs.repartition(7), pieces).collect()
        assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == Counter((r["doc_id"], tuple(r["ids"])) for r in two)
        back = piece_sampling.decode_pieces(one.drop("decoded"), pieces)
        assert Counter(r["text"] for r in back.collect()) == Counter(r["text"] or "" for r in got)
    sp = sentencepiece.SentencePieceProcessor(model_proto=pieces)
    assert all(sp.decode(list(r["ids"])) == r["text"] for r in got)


def test_sampling_holds_little_beside_its_texts(spark, pieces):
    """Two workers stand beside an executor's JVM: many new units at once may not take hundreds of megabytes, nor a text go twice."""
    import tracemalloc

    sampler = piece_sampling.Sampler(pieces, piece_sampling.SHARPNESS, 1)
    sampler.vocabulary.tree()
    text = " ".join(f"unit{i * 7919}" for i in range(120_000))
    tracemalloc.start()
    sampler.encode([1], [text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 140e6  # 194 MB with 50,000 units together
    docs = spark.createDataFrame([(1, "some text", "x")], "doc_id long, text string, other string")
    for keep, columns in ((("doc_id", "text"), ["key", "row"]), (("doc_id",), ["key", "row", "body"])):
        made = piece_sampling.sample_pieces(docs, pieces, keep=keep)
        plan = made._jdf.queryExecution().analyzed().toString()
        sent = re.search(r"MapInArrow encode\(([^)]*)\)", plan).group(1)
        assert re.findall(r"(\w+)#", sent) == columns


def test_sampling_has_the_lattice_distribution(pieces):
    sampler = piece_sampling.Sampler(pieces, 1 / 3000, 1)
    unit, vocabulary = "▁there", Vocabulary(pieces)
    ways = {}
    for end, length, i, score in vocabulary.matches(unit):
        ways.setdefault(end, []).append((end - length, i, score / 3000))

    def paths(end):
        if end == 0:
            yield (), 0.0
        for start, i, score in ways.get(end, []):
            for ids, s in paths(start):
                yield (*ids, i), s + score

    weights = {ids: math.exp(s) for ids, s in paths(len(unit))}
    n = 40_000
    ids, counts = sampler.encode(list(range(n)), ["there"] * n)
    ends = np.cumsum(counts)
    seen = Counter(tuple(ids[e - c : e].tolist()) for e, c in zip(ends, counts))
    for path, w in weights.items():
        p = w / sum(weights.values())
        assert abs(seen[path] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_lattices_of_many_units_equal_those_of_single_ones(pieces, monkeypatch):
    units = ["▁there", "▁▁▁", "a", "日本語", "x\U0001f600y", "e\u0301", "\x00\r", "z" * 64, "▁internationalisation.", "https://a.b/c?d=1"]
    vocabulary = Vocabulary(pieces)
    single, many = (piece_sampling.Lattices(vocabulary, 1 / 2000) for _ in range(2))
    want = [single.add(u) for u in units]
    # New units that are not long are filtered together, in one call for all of them.
    monkeypatch.setattr(many, "add", None)
    got = many.look_up(units).tolist()
    assert many.look_up(units[::-1]).tolist() == got[::-1]
    numbers = np.arange(3000, dtype="u8")
    for a, b in zip(want, got):
        single.tables = tuple(np.array(x, "i8") for x in (single.limits, single.target, single.emit))
        one, sizes = single.sample(np.full(3000, a), piece_sampling.mixed(numbers))
        two, others = many.sample(np.full(3000, b), piece_sampling.mixed(numbers))
        spell = [[(v.atom_bytes[i - len(vocabulary.decoded)] if i >= len(vocabulary.decoded) else i) for i in x.tolist()]
                 for v, x in ((single, one), (many, two))]
        assert spell[0] == spell[1] and (sizes == others).all()


def test_archives_reject_magic_in_payloads(spark):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = [(i, f"http://h/{i}", [fake * 3, "x" * (37 * i), None, "same", fake + str(i)][i % 5], "extra") for i in range(120)]
    rows += [(None, None, "same", None), (None, None, "lonely", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string").repartition(3)
    manifest = warc.write_archives(pages, shared_folder(), file_bytes=20_000)
    assert manifest.count() > 2
    for block in (64, 1000, 1 << 24):
        got = warc.read_archives(manifest, block=block).collect()
        last = {}
        for i, _, h, _ in rows:
            last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
        want = Counter()
        for i, _, h, _ in rows:
            h = h or ""
            other = last[h] if last[h] >= 0 and i != last[h] else None
            want[i, len(h), "response" if other is None else "revisit", other] += 1
        assert Counter((r["key"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got) == want
        assert all(r["payload"].decode() == dict((i, h or "") for i, _, h, _ in rows)[r["key"]]
                   for r in got if r["record_type"] == "response" and r["key"] is not None)
    assert warc.read_archives(warc.write_archives(pages.limit(0), shared_folder())).count() == 0


def test_addresses_come_back_as_they_were(spark):
    urls = ["http://ex.org/a%20b?q=1", "http://ex.org/straße a?q=é", "http://ex.org/stra%C3%9Fe%20a?q=%C3%A9", "", None, "x\r\nWARC-Type: y", " ", "😀" * 5000]
    pages = spark.createDataFrame([(i, u, f"body {i // 2}") for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = warc.read_archives(warc.write_archives(pages, shared_folder())).collect()
    assert {r["key"]: r["url"] for r in got} == {i: u or "" for i, u in enumerate(urls)}
    head = warc.record(1, urls[1], b"", None, "d").split(b"\r\n\r\n")[0]
    assert b"WARC-Target-URI: http://ex.org/stra%C3%9Fe%20a?q=%C3%A9\r\n" in head


def test_ledger_scans_only_what_is_new(spark, odd):
    ledger = f"{shared_folder()}/ledger"
    first = spark.createDataFrame(
        [("a", 1, "token: abcdef \U0001f600 AKIA" + "A" * 16), ("b", 1, "x" * 5), ("c", 1, "x" * 5)], "path string, version int, text string"
    )
    got = secret_ledger.scan_paths(first, ledger, ["path", "version"])
    assert {r["path"]: secret_texts(r) for r in got.collect()} == {"a": [("assign", 0, 13), ("access", 16, 36)], "b": [], "c": []}
    n = secret_ledger.read_ledger(spark, ledger).count()
    assert n == 2 * len(secret_ledger.RULES)
    more = first.union(spark.createDataFrame([("a", 2, "0" * 24), ("d", 1, "x" * 5)], first.schema))
    secret_ledger.scan_paths(more, ledger, ["path", "version"]).collect()
    assert secret_ledger.read_ledger(spark, ledger).count() == n + len(secret_ledger.RULES)
    newer = tuple(secret_ledger.Rule(r.kind, "2" if r.kind == "hex" else r.version, r.pattern, r.probe, r.group, r.least) for r in secret_ledger.RULES)
    secret_ledger.scan_paths(more, ledger, ["path", "version"], rules=newer).collect()
    assert secret_ledger.read_ledger(spark, ledger).count() == n + len(secret_ledger.RULES) + 3
    assert secret_ledger.scan_paths(odd, f"{shared_folder()}/l", ["doc_id"]).count() == len(ODD)


def secret_texts(row):
    return [(s["kind"], s["start"], s["end"]) for s in row["spans"]]


def test_binomial_tail_is_exact(spark):
    rows = [(r, n) for n in (10, 500, 20_000) for r in (0, 1, 3, 20) if r < n * 0.05]
    got = spark.createDataFrame(rows, "r long, n long").select(
        "r", "n", quality_rules.binomial_tail(F.col("r"), F.col("n"), 0.05).alias("p")
    ).collect()
    for r, n, p in got:
        want = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(0.05) + (n - i) * math.log(0.95)) for i in range(r + 1))
        assert math.isclose(p, want, rel_tol=1e-6)


def test_cutoffs_keep_good_documents(spark, odd, none):
    body = " ".join(f"word{i}" for i in range(60))
    good = [(i, body + " #" * (2 if i < 5 else 0), "en", "s", 0, "", "", "") for i in range(4000)]
    bad = [(5000 + i, body + " #" * 30, "en", "s", 0, "", "", "") for i in range(50)]
    few = [(9000, body + " #" * 30, "de", "s", 0, "", "", "")]
    docs = spark.createDataFrame(good + bad + few, DOCS)
    labels = spark.createDataFrame([(i, 1) for i in range(4000)] + [(5000, 0), (None, 1), (7, None)], "doc_id long, quality int")
    left = quality_rules.quality_filter(docs, labels)
    ids = {r["doc_id"] for r in left.collect()}
    # Bad ones go, good ones stay; a stratum without labels has only the base rules.
    assert ids == set(range(4000)) | {9000} and left.columns == docs.columns
    chosen = quality_rules.calibrate(odd, labels)
    assert quality_rules.judge(odd, chosen).count() == len(ODD)
    assert quality_rules.quality_filter(none, labels.limit(0)).count() == 0


def test_repeated_words_count_covered_words(spark):
    texts = ["a b c a b c", "a a a a", "a b c d a b", "", "x y", "a b c d e a b c q r s d e a"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["row"]["doc_id"]: r["n_repeat_words"] for r in quality_rules.measured(got).collect()}
    for i, t in enumerate(texts):
        w = t.split()
        c = Counter(tuple(w[j : j + 3]) for j in range(len(w) - 2))
        assert got[i] == len({j + d for j in range(len(w) - 2) if c[tuple(w[j : j + 3])] > 1 for d in range(3)})


def test_measures_equal_plain_counts(spark):
    """Blanks, symbols at both ends, characters beyond ASCII, and windows that occur often or once among many."""
    texts = [
        None, "", " ", "a", "#", "$a# b%\n#\n\n \t\n#", "\x0b\x0c\r\n|", "\U0001f600 z\U0001f600 & \x85 \x1c b\n<\n<", "x " * 3000,
        " ".join(f"w{i % 700}" for i in range(1000)), " ".join(f"w{i}" for i in range(1500)) + " w0 w1 w2",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["row"]["doc_id"]: tuple(r)[1:] for r in quality_rules.measured(docs).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        c = Counter(zip(w, w[1:], w[2:]))
        often = {j + d for j, x in enumerate(zip(w, w[1:], w[2:])) if c[x] > 1 for d in range(3)}
        symbols = sum(x in quality_rules.SYMBOLS for x in t)
        assert got[i] == (len(w), sum(map(len, w)), symbols, len(lines), len(lines) - len(set(lines)), len(often))


def test_windows_are_not_sorted_as_structs(spark):
    """Sorting a struct for each window took most of the time of the rules; only windows that may occur twice are structs."""
    docs = spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string")
    plan = quality_rules.measured(docs)._jdf.queryExecution().optimizedPlan().toString()
    made_of_places = plan.split("sequence(")[1].split("lambdafunction(")[1]
    assert not made_of_places.startswith("struct(")


def test_licences_match_after_normalising(spark, odd):
    text = dict(license_scan.KNOWN)["ISC"]
    docs = spark.createDataFrame(
        [(1, "Copyright (c) 1999 Somebody\n" + text.upper()), (2, "intro\nReleased under the MIT Licence!\n"), (3, text + " more")],
        "doc_id long, text string",
    )
    got = {r["doc_id"]: (r["text_license"], r["notices"]) for r in license_scan.license_matches(docs, license_scan.known_licences(spark)).collect()}
    assert got == {1: ("ISC", []), 2: (None, ["MIT"]), 3: (None, [])}
    assert license_scan.license_matches(odd, license_scan.known_licences(spark)).count() == len(ODD)


def test_published_licences_are_known(spark):
    import public_tokenizers

    common = "/usr/share/common-licenses/"
    names = {
        "Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0-Perl", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0",
        "GFDL-1.2": "GFDL-1.2-only", "GFDL-1.3": "GFDL-1.3-only", "GPL-1": "GPL-1.0-only", "GPL-2": "GPL-2.0-only",
        "GPL-3": "GPL-3.0-only", "LGPL-2": "LGPL-2.0-only", "LGPL-2.1": "LGPL-2.1-only", "LGPL-3": "LGPL-3.0-only",
        "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0",
    }
    texts = {file: open(common + file, encoding="utf-8").read() for file in names}
    cases = [(names[file], text) for file, text in texts.items()]
    gpl, apache = texts["GPL-3"], texts["Apache-2.0"]
    cases += [
        ("GPL-3.0-only", gpl[gpl.index("Copyright (C)"):]), ("GPL-3.0-only", gpl[:gpl.index("How to Apply")]),
        ("Apache-2.0", apache[apache.index("TERMS AND"):]), ("Apache-2.0", apache.replace("copyright owner", "copyright holder")),
        (None, gpl + " more"),
    ]
    with open(os.path.join(os.path.dirname(public_tokenizers.__file__), "LICENSES.txt"), encoding="utf-8") as file:
        listed = file.read()
    mit = listed[listed.index("MIT License"):listed.index("word_bpe_49k.json")]
    cases += [("MIT", mit), ("MIT", mit.replace("MIT License", "")), ("MIT", mit.replace("MIT License", "The MIT License (MIT)"))]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: r["text_license"] for r in license_scan.license_matches(docs, license_scan.known_licences(spark)).collect()}
    assert got == {i: n for i, (n, _) in enumerate(cases)}
    pairs = [("favourite", "favorite"), ("offence", "offense"), ("optimise", "optimize"), ("copyright owner", "copyright holder")]
    rows = spark.createDataFrame(pairs, "a string, b string")
    assert rows.where(license_scan.canonical(F.col("a")) == license_scan.canonical(F.col("b"))).count() == len(pairs)


def brute_leaks(docs, items):
    def split(t):
        return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]

    out = Counter()
    windows = []
    for i, t in items:
        w = split(t)
        n = min(10, len(w))
        windows += [(i, tuple(w[j : j + n])) for j in range(len(w) - n + 1)] if w else []
    for k, t in docs:
        w, hit, found = split(t), set(), set()
        for i, g in windows:
            for j in range(len(w) - len(g) + 1):
                if tuple(w[j : j + len(g)]) == g:
                    hit |= set(range(j, j + len(g)))
                    found.add(str(i))
        out[k, len(w), len(hit), len(found)] += 1
    return out


def test_leaks_equal_all_windows(spark, odd, folder):
    items = [(1, "b c d e f g h i j k zz"), (2, "another text"), (3, "one"), (4, None), (5, ""), (6, "x y é"), (6, "a b c d e f g h i j")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contaminated_documents(odd, bench).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"]) for r in got) == brute_leaks([(r[0], r[1]) for r in ODD], items)
    left = decontamination.clean_documents(odd, bench)
    assert left.columns == odd.columns and sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5, 6]
    assert decontamination.clean_documents(odd, bench.limit(0)).count() == len(ODD)


def test_empty_tables(none, pieces):
    spark = none.sparkSession
    bench = spark.createDataFrame([], "item_id long, text string")
    assert minhash_dedup.drop_near_copies(none).count() == 0
    assert line_dedup.drop_lines(none).count() == 0
    assert decontamination.contaminated_documents(none, bench).count() == 0
    assert token_counts.count_tokens(none, pieces).count() == 0
    assert piece_sampling.sample_pieces(none, pieces).count() == 0
    assert secret_ledger.scan_paths(none, f"{shared_folder()}/l", ["doc_id"]).count() == 0
    assert license_scan.license_matches(none, license_scan.known_licences(spark)).count() == 0
    model = tokenizer_file("word_bpe_49k.json")
    assert token_frames.read_shards(token_frames.write_shards(none, shared_folder(), model, 2)).count() == 0


def test_pipeline_stages_equal_brute_force(spark, corpus, folder):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "minhash_dedup", "decontamination", "piece_sampling"
    ]
    docs, kept = corpus.where("doc_id < 120"), {}
    for name, function in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        made = function(spark, docs, folder).collect()
        kept[name] = (before, made)
        if name != "piece_sampling":
            docs = spark.createDataFrame(made, corpus.schema)
    before, made = kept["line_dedup"]
    gone = brute_lines(before)
    want = {}
    for k, t in before:
        rest = [x for i, x in enumerate(t.split("\n")) if (k, i) not in gone]
        if len(rest) == len(t.split("\n")) or "".join(rest).strip():
            want[k] = "\n".join(rest)
    assert {r["doc_id"]: r["text"] for r in made} == want and all(r["n_chars"] == len(r["text"]) for r in made)
    before, made = kept["minhash_dedup"]
    assert {r["doc_id"] for r in made} == {k for k, _, c in brute_components(before, 5) if k == c}
    before, made = kept["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert {r["doc_id"] for r in made} == {k for k, _, hit, _ in brute_leaks(before, items) if not hit}
    before, made = kept["piece_sampling"]
    assert len(made) == len(before) and all(r["lossless"] for r in made)


def test_every_operator_is_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
