"""Quality rules, BPE, substring removal and SimHash against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
import tiktoken

from conftest import prose  # noqa: F401  (kept beside the operators' own fixtures)
from pagetally.llm import bpe, quality_rules, simhash, substring_dedup
from pagetally.llm.queries import PATTERN, VOCABULARY


def words(text):
    return (text or "").encode().split()


# --- quality rules ---------------------------------------------------------------------------


def measures(text):
    text = text or ""
    own, chars = words(text), 0
    for w in own:
        chars += len(w.decode())
    lines = [x for x in text.split("\n") if words(x)]
    grams = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
    twice, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if twice[g] > 1:
            covered |= set(range(i, i + 5))
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(own), chars, sum(c in "#*$%&|<>" for c in text), len(lines), dup, len(covered)


def test_measures_equal_brute_force(odd_rows):
    rnd = random.Random(1)
    texts = [r[1] for r in odd_rows if len(r[1] or "") < 5000]
    texts += ["".join(rnd.choice("ab \n#") for _ in range(rnd.randrange(80))) for _ in range(300)]
    for text in texts:
        assert quality_rules.measure(text) == measures(text)


def test_rules_give_every_row_a_verdict(odd, odd_rows, none):
    rows = quality_rules.apply_rules(odd).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in odd_rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].base_failed and by_id[2].base_failed and not by_id[0].kept
    assert by_id[9].base_failed and by_id[12].n_words == 30_000 and not by_id[12].base_failed
    assert quality_rules.apply_rules(none).count() == 0


def test_thresholds_follow_language_and_source(spark):
    """Symbols are normal in one source and odd in another of the same language."""
    rnd, rows = random.Random(2), []
    for i in range(1600):
        text = prose(rnd, 40)
        if i % 2:
            text = " ".join(f"#{w}" for w in text.split())
        rows.append((i, text, "en", "tags" if i % 2 else "plain", None))
    rows.append((5000, "#" * 200 + " " + prose(rnd, 40), "en", "plain", None))
    rows.append((5001, " ".join(f"##{w}" for w in prose(rnd, 40).split()), "en", "tags", None))
    rows.append((5002, "####################" + " ".join(f"#{w}" for w in prose(rnd, 40).split()), "en", "rare", None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long")
    bad = {r.doc_id for r in quality_rules.apply_rules(docs).collect() if not r.kept}
    assert bad == {5000, 5001}  # the rare source takes the language's sketch, with both kinds


def plain_lines(rnd, n, words=8):
    return "\n".join(prose(rnd, words, 4000) for _ in range(n))


def test_each_rule_rejects_a_row_of_its_own(spark):
    """Rows that pass the base rules, and fail one rule alone, in a source where such do not occur;
    in another one, where they are common, they stay."""
    rnd = random.Random(11)
    lines = [prose(rnd, 9, 4000) for _ in range(12)]
    short = ["ab cd", "ef gh"]
    odd = {
        "symbols_per_word": " ".join(w + "#" * (i % 8 == 0) for i, w in enumerate(prose(rnd, 80, 4000).split())),
        "word_length": " ".join("longwordlongword" + w for w in prose(rnd, 60, 4000).split()),
        "dup_lines": "\n".join(x for one in lines for x in (one, short[0], prose(rnd, 9, 4000), short[1])),
        "repeat_words": " ".join([prose(rnd, 60, 4000), *[" ".join(lines[0].split()[:6])] * 2]),
    }
    rows = [(i, plain_lines(rnd, 10), "en", "plain", None) for i in range(600)]
    rows += [(1000 + i, text, "en", "plain", None) for i, text in enumerate(odd.values())]
    common = [list(odd.values())[k] for k in (0, 0, 1, 1, 2, 3)]
    rows += [(2000 + i, common[i % 6], "en", "mixed", None) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long")
    judged = {r.doc_id: r for r in quality_rules.apply_rules(docs).collect()}
    for i, name in enumerate(odd):
        assert not judged[1000 + i].base_failed and judged[1000 + i].failed_rules == [name]
    assert all(r.kept for i, r in judged.items() if not 1000 <= i < 2000)


def test_sketches_merge(spark):
    """The sketch of two halves, added up, is the sketch of the whole; quantiles are near."""
    values = [int(random.Random(5).lognormvariate(8, 2)) for _ in range(1)] + [
        int(x) for x in np.random.default_rng(5).lognormal(8, 2, 4000)
    ]
    rules = {r.name: "value" for r in quality_rules.RULES}
    rows = spark.createDataFrame([(v, i % 2) for i, v in enumerate(values)], "value long, half int")
    rows = rows.selectExpr("half", *[f"{v} as {k}" for k, v in rules.items()])
    halves = quality_rules.sketches(rows, ("half",))
    key = lambda df: sorted(map(tuple, df.select("rule", "bucket", "n").collect()))
    whole = quality_rules.sketches(rows, ())
    assert key(quality_rules.merged(halves, ())) == key(whole)
    found = quality_rules.quantiles(whole, ()).first()
    ordered = sorted(values)
    for q, got in ((0.01, found.q1), (0.25, found.q25), (0.75, found.q75), (0.99, found.q99)):
        exact = ordered[int(np.ceil(q * len(ordered))) - 1]
        assert exact * (1 - 1 / 64) <= got <= exact


# --- BPE -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference_encoding():
    ranks = bpe.load_ranks(VOCABULARY)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_bytes_equal_the_library(odd, odd_rows, reference_encoding):
    encoded = bpe.encode(odd, VOCABULARY, PATTERN)
    rows = bpe.with_digests(bpe.decode(encoded, VOCABULARY, PATTERN)).collect()
    at_once = bpe.with_digests(bpe.encode(odd, VOCABULARY, PATTERN, back=True))
    assert sorted(map(str, at_once.collect())) == sorted(map(str, rows))
    want = defaultdict(list)
    for doc_id, text, *_ in odd_rows:
        ids = reference_encoding.encode_ordinary(text or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want[doc_id].append((len(ids), digest, (text or "").encode()))
    assert len(rows) == len(odd_rows)
    for r in rows:
        assert (r.n_tokens, r.ids_sha256, bytes(r.decoded)) in want[r.doc_id]
        assert r.decoded_sha256 == hashlib.sha256(bytes(r.decoded)).hexdigest()


def test_random_texts_and_all_bytes(reference_encoding):
    coder = bpe.ByteBpe(bpe.serialise_model(bpe.load_ranks(VOCABULARY)), PATTERN, cache=50)
    rnd = random.Random(4)
    alphabet = "ab'sé ß\n\t　漢字🙂0 1\x00­<|endoftext|>A" + "".join(map(chr, range(32, 900, 7)))
    for _ in range(400):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(120)))
        packed = coder.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == reference_encoding.encode_ordinary(text)
        assert coder.decode(packed) == text.encode()
    word = "abcdefghij" * 3000
    assert np.frombuffer(coder.encode(word), "<u4").tolist() == reference_encoding.encode_ordinary(word)
    every = coder.decode(np.arange(len(coder.bytes_of), dtype="<u4").tobytes())
    assert every == b"".join(coder.bytes_of) and len(coder.bytes_of) == len(bpe.load_ranks(VOCABULARY))


def test_another_vocabulary():
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coder = bpe.ByteBpe(bpe.serialise_model(ranks), PATTERN)
    other = tiktoken.Encoding("b", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = "It's twelve o'clock; naïve façade, 12345 times."
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == other.encode_ordinary(text)


def test_vocabularies_must_be_whole():
    ranks = bpe.load_ranks(VOCABULARY)
    with pytest.raises(ValueError):
        bpe.serialise_model({t: r + 1 for t, r in ranks.items()})
    with pytest.raises(ValueError):
        bpe.serialise_model({b"a": 0, b"b": 1})


def test_no_documents(none):
    encoded = bpe.encode(none, VOCABULARY, PATTERN, keep=("lang",))
    assert encoded.columns == ["doc_id", "lang", "n_tokens", "ids"] and encoded.count() == 0


# --- substring removal -----------------------------------------------------------------------


def without_repeats(rows, window=13):
    """(doc_id, words, words left) by a dictionary of all windows."""
    first = {}
    for doc_id, text in rows:
        own = words(text)
        if doc_id is not None:
            for i in range(len(own) - window + 1):
                w = tuple(own[i : i + window])
                first[w] = min(first.get(w, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        own = words(text)
        gone = set()
        if doc_id is not None:
            for i in range(len(own) - window + 1):
                if first[tuple(own[i : i + window])] < doc_id:
                    gone |= set(range(i, i + window))
        left = [w for i, w in enumerate(own) if i not in gone]
        out.append((doc_id, len(own), len(gone), b" ".join(left).decode()))
    return out


def found(df):
    return sorted(map(str, (tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_text").collect())))


def test_removal_equals_brute_force_on_odd_documents(odd, odd_rows, none):
    left = substring_dedup.dedup(odd)
    assert found(left) == sorted(map(str, without_repeats([r[:2] for r in odd_rows])))
    assert {"score", "check", "block"} <= set(left.columns)
    assert sorted(str(r.text) for r in left.collect()) == sorted(str(r[1]) for r in odd_rows)
    assert substring_dedup.dedup(none).count() == 0


@pytest.mark.parametrize("pack", [1, 4 << 20])
def test_removal_equals_brute_force_on_random_texts(spark, monkeypatch, pack):
    """Few words, so that windows repeat within and across documents; hot passages; tasks that
    pack one document at a time or all at once."""
    monkeypatch.setattr(substring_dedup, "PACK", pack)
    rnd, rows = random.Random(8), []
    passages = [prose(rnd, 30, 5) for _ in range(4)]
    for i in range(250):
        parts = [prose(rnd, rnd.randrange(0, 40), rnd.choice((2, 50))) for _ in range(3)]
        parts.insert(rnd.randrange(3), passages[min(rnd.randrange(12), 3)])
        rows.append((rnd.randrange(10_000), "\n".join(parts)))
    rows = list({d: (d, t) for d, t in rows}.values()) + [rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(substring_dedup.dedup(docs)) == sorted(map(str, without_repeats(rows)))


@pytest.mark.parametrize("pack", [1, 4 << 20])
def test_buckets_beyond_one_exchange_equal_brute_force(spark, odd, odd_rows, monkeypatch, pack):
    """Two exchanges: pieces by group, then by bucket; hot windows and settled ones among them."""
    monkeypatch.setattr(substring_dedup, "FAN", 3)
    monkeypatch.setattr(substring_dedup, "PACK", pack)
    monkeypatch.setattr(substring_dedup, "LEAST", 1)
    monkeypatch.setattr(substring_dedup, "parts", lambda docs: 11)
    assert found(substring_dedup.dedup(odd)) == sorted(map(str, without_repeats([r[:2] for r in odd_rows])))
    rows = template_rows(120)
    rows += [(1000 + i, text) for i, (_, text) in enumerate(rows[:40])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(substring_dedup.dedup(docs)) == sorted(map(str, without_repeats(rows)))


def test_layout_has_enough_buckets():
    fan = substring_dedup.FAN
    assert [substring_dedup.layout(n) for n in (1, 51, fan)] == [(1, 1), (51, 1), (fan, 1)]
    for n in (fan + 1, 40_000, 400_000, 4_000_000):
        groups, per = substring_dedup.layout(n)
        assert n <= groups * per <= 1.05 * n and max(groups, per) <= fan


def test_pieces_stay_large_at_any_number_of_buckets():
    """Bytes written in an exchange for each byte of text, with 40,000 buckets and with 51."""
    rnd = random.Random(13)
    docs, size = [], 0
    while size < substring_dedup.PACK:
        own = prose(rnd, rnd.randrange(20, 600), 3000).encode().split()
        docs.append((len(docs), len(docs), own))
        size += sum(map(len, own)) + len(own)

    def written(buckets):
        return [p for _, p in substring_dedup._buckets_of(docs, buckets, 13, substring_dedup.NO_HOT)]

    few = sum(map(len, written(51)))
    groups, per = substring_dedup.layout(40_000)
    assert sum(map(len, written(groups))) < 1.2 * few
    again = [p for _, p in substring_dedup._split(written(1), per)]
    assert sum(map(len, again)) < 1.2 * few and len(again) <= per


def test_super_kmers_hold_every_window_once():
    rnd = random.Random(9)
    docs = [prose(rnd, n, 20).encode().split() for n in (0, 12, 13, 40, 300)]
    tokens, ends = [t for d in docs for t in d], np.cumsum([len(d) for d in docs]).tolist()
    of, start, count, low = substring_dedup.super_kmers(tokens, ends)
    seen = [(o, s + k) for o, s, n in zip(of, start, count) for k in range(n)]
    want = [(i, (ends[i] - len(d)) + k) for i, d in enumerate(docs) for k in range(len(d) - 12)]
    assert sorted(seen) == sorted(want)
    # Equal windows have equal minimisers, wherever they stand.
    by_window = defaultdict(set)
    for s, n, m in zip(start, count, low):
        for k in range(n):
            by_window[tuple(tokens[s + k : s + k + 13])].add(int(m))
    assert all(len(m) == 1 for m in by_window.values())


def template_rows(n=300):
    """Documents with one line of a template, where a name stands within each 13 words."""
    rnd = random.Random(12)
    line = [f"template{k}" for k in range(60)]
    rows = []
    for i in range(n):
        own = [f"name{i % (n - 20)}x{k}" if k % 10 == 5 else w for k, w in enumerate(line)]
        rows.append((i, " ".join([prose(rnd, 15, 4000), *own, prose(rnd, 15, 4000)])))
    return rows


def test_windows_of_a_hot_minimiser_spread(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SAMPLE", 1)
    monkeypatch.setattr(substring_dedup, "LEAST", 1)
    rows = template_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    checked = docs.selectExpr("doc_id", "crc32(text) check", "text")
    hot = substring_dedup.hot_minimisers(checked, 40)
    assert 0 < len(hot) <= 40
    # The most windows that have one minimiser, or one hash in its place, in average buckets.
    most = []
    tokens = [w for _, text in rows for w in words(text)]
    ends = np.cumsum([len(words(text)) for _, text in rows]).tolist()
    for known in (substring_dedup.NO_HOT, hot):
        _, _, count, low = substring_dedup.super_kmers(tokens, ends, hot=known)
        most.append(40 * np.bincount(np.unique(low, return_inverse=True)[1], count).max() / count.sum())
    assert most[0] > 4 and most[1] < 1
    assert found(substring_dedup.dedup(docs)) == sorted(map(str, without_repeats(rows)))


# --- SimHash ---------------------------------------------------------------------------------


def plain_fingerprint(text):
    import xxhash

    own = (text or "").encode().lower().split()
    if not own:
        return 0
    shingles = [b" ".join(own[i : i + 3]) for i in range(max(1, len(own) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(pairs, radius):
    """Smallest id reachable, per position of (id, bits)."""
    label = [i for i, _ in pairs]
    changed = True
    while changed:
        changed = False
        for a, (i, x) in enumerate(pairs):
            for b, (j, y) in enumerate(pairs):
                if i is not None and j is not None and (i == j or (x ^ y).bit_count() <= radius):
                    low = min(label[a], label[b])
                    changed |= label[a] != low or label[b] != low
                    label[a] = label[b] = low
    return label


def test_fingerprints_and_groups_equal_brute_force(odd, odd_rows, none):
    rows = simhash.near_duplicates(odd).collect()
    plain = [(r[0], plain_fingerprint(r[1])) for r in odd_rows]
    want = sorted(
        str((i, f"{bits:016x}", label if i is not None else None))
        for (i, bits), label in zip(plain, groups(plain, 3))
    )
    assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in rows) == want
    assert simhash.near_duplicates(none).count() == 0


def test_java_hash_is_the_same(spark):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([("one two three",)], "s string").select(F.xxhash64("s").alias("h")).first()
    assert row.h % (1 << 64) == simhash.fingerprint("One two THREE")


@pytest.mark.parametrize("radius", [1, 3, 6])
def test_every_pair_within_the_radius_meets(radius):
    masks = simhash.covering(list(range(64)), radius, 0)
    assert len(masks) <= 2 ** (radius + 1) - 1
    rnd = random.Random(radius)
    for _ in range(3000):
        difference = sum(1 << b for b in rnd.sample(range(64), radius))
        assert any(not difference & m for m in masks)
    if radius == 3:
        assert {m.bit_count() for m in masks} == {32}


@pytest.mark.parametrize("bucket", [2, 16_384])
def test_large_buckets_are_split_without_loss(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rnd = random.Random(11)
    prints, centre = set(), rnd.getrandbits(64)
    for _ in range(60):
        prints.add(centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(6))))
        prints.add(rnd.getrandbits(64))
    pairs = list(enumerate(sorted(prints)))
    frame = spark.createDataFrame(
        [(i, b - (1 << 64) if b >> 63 else b) for i, b in pairs], "doc_id long, bits long"
    )
    got = {r.doc_id: r.component for r in simhash.classes(frame).collect()}
    assert [got[i] for i, _ in pairs] == groups(pairs, 3)


def test_one_row_of_each_group_stays(odd, odd_rows):
    left = simhash.representatives(odd)
    assert left.columns == odd.columns
    ids = [r.doc_id for r in left.collect()]
    plain = [(r[0], plain_fingerprint(r[1])) for r in odd_rows]
    want = {c for (i, _), c in zip(plain, groups(plain, 3)) if i is not None}
    assert sorted(i for i in ids if i is not None) == sorted(want)
    assert ids.count(None) == 2
