"""Collocations, exact copies and conversation repair against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from conftest import frame
from pagetally.llm import collocations, conversation_repair, exact_dedup
from pagetally.llm.collocations import Rules
from pagetally.llm.queries import QUERIES, table

SMALL = "/root/testdata/sf0.001"


# --- collocations ----------------------------------------------------------------------------


def phrases(rows, rules):
    """(lang, rank, phrase, a, l, r, n, score) of (text, lang) by counting every n-gram."""
    found, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, rules.longest + 1):
                found.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    some = {k: v for k, v in found.items() if len(k[1]) > 1 and v >= rules.least}
    gone = {
        (lang, w[i : i + m])
        for (lang, w), v in some.items()
        for m in range(2, len(w))
        for i in range(len(w) - m + 1)
        if 100 * v >= rules.inside * found[lang, w[i : i + m]]
    }
    ranked = defaultdict(list)
    for (lang, w), a in some.items():
        if (lang, w) not in gone:
            parts = [(found[lang, w[:k]], found[lang, w[k:]]) for k in range(1, len(w))]
            score, _, left, right = min((1000000 * a * a // (x * y), k, x, y) for k, (x, y) in enumerate(parts))
            ranked[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted(
        (lang, rank, w.decode(), -a, left, right, n[lang], -score)
        for lang, rows in ranked.items()
        for rank, (score, a, w, left, right) in enumerate(sorted(rows)[: rules.top], 1)
    )


@pytest.mark.parametrize("rules", [Rules(), Rules(least=2, top=7), Rules(longest=4, least=3, inside=80), Rules(longest=2, least=1)])
def test_collocations_equal_brute_force(spark, odd, odd_rows, rules):
    got = collocations.collocations(odd, rules)
    assert sorted(map(tuple, got.collect())) == phrases([(r[1], r[2]) for r in odd_rows], rules)


def test_collocations_of_hot_words_ties_and_pieces(spark):
    rnd = random.Random(4)
    texts = ["the " + " the ".join(f"n{rnd.randrange(30)}" for _ in range(40)) for _ in range(60)]
    texts += ["Aa bB. Cc,dd;ee:ff!gg?hh\nii\vjj\fkk\rll\tmm nn Éa éA  oo"] * 12 + ["q q q q q q"] * 5 + ["...", " . ", ",,a b,,"] * 11
    docs = frame(spark, [(i, t, ("en", None, "und")[i % 3], "s", 1) for i, t in enumerate(texts)]).repartition(8)
    got = collocations.collocations(docs, Rules(least=5))
    want = phrases([(t, ("en", None, "und")[i % 3]) for i, t in enumerate(texts)], Rules(least=5))
    assert sorted(map(tuple, got.collect())) == want and len(want) > 30


def test_windows_are_padded_from_rare_pairs_on(spark, odd, odd_rows, none, monkeypatch):
    """Whatever the table of pairs and the chunks are, every word begins one window; pairs that are
    not rare are never padded."""
    n = phrases([(r[1], r[2]) for r in odd_rows], Rules(least=2, top=1))
    words = sum({r[0]: r[6] for r in n}.values())
    every, nothing = np.full(1 << 12, 255, np.uint8), np.zeros(1 << 12, np.uint8)
    for table in (every, nothing, collocations.frequent_pairs(odd, 2)):
        assert collocations.windows(odd, 3, table).agg({"n": "sum"}).first()[0] == words
    assert collocations.windows(odd, 3, nothing).where("w2 is not null").count() == 0
    full = {tuple(r) for r in collocations.windows(odd, 2, every).collect() if r.w2 is not None and r.n >= 2}
    some = {tuple(r) for r in collocations.windows(odd, 2, collocations.frequent_pairs(odd, 2)).collect()}
    assert full and full <= some
    assert collocations.collocations(none).count() == 0


def test_chunks_cut_long_texts_between_pieces():
    rnd = random.Random(7)
    text = "".join(rnd.choice("aB .,\n\tc") for _ in range(5000))
    batch = pa.RecordBatch.from_pydict({"lang": ["en", None, "en"], "text": [text, text, None]})

    def pieces(size):
        found = Counter()
        for lang, ids, words in collocations._chunks(iter([batch]), size):
            for piece in b" ".join(words[i] for i in ids).split(b"."):
                found[lang, piece.strip()] += bool(piece.strip())
        return +found

    assert pieces(1) == pieces(64) == pieces(1 << 20)
    assert {lang for lang, _ in pieces(64)} == {"en", "und"}


def test_products_beyond_64_bits(spark):
    big = 3_037_000_500
    rows = [("en", 1, "a", 2 * big), ("en", 1, "b", 3 * big), ("en", 2, "a b", big), ("en", 0, "", 9 * big)]
    counted = spark.createDataFrame(rows, "lang string, size int, phrase string, n long")
    row = collocations.candidates(counted).first()
    assert (row.a, row.l, row.r, row.score) == (big, 2 * big, 3 * big, 1000000 // 6)


# --- exact copies ----------------------------------------------------------------------------


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


@pytest.mark.parametrize("fan", [2, 3, 8])
def test_copies_equal_brute_force(odd, odd_rows, fan):
    groups = defaultdict(list)
    for row in odd_rows:
        groups[digest(row[1])].append(row[0])
    got = exact_dedup.mark(odd, fan=fan).collect()
    ids = {h: min((i for i in own if i is not None), default=None) for h, own in groups.items()}
    want = [(r[0], ids[digest(r[1])], len(groups[digest(r[1])]), digest(r[1])) for r in odd_rows]
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted(map(key, [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got])) == sorted(map(key, want))
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert kept == Counter(set(groups)) and all(r.doc_id == r.keep_id for r in got if r.kept)


def test_rows_that_stay_have_all_columns(spark, odd, none):
    left = exact_dedup.deduplicate(odd)
    assert left.dtypes == odd.dtypes
    assert left.count() == exact_dedup.mark(odd).where("kept").count()
    assert exact_dedup.mark(none).count() == exact_dedup.deduplicate(none).count() == 0


def test_one_text_with_a_third_of_all_rows(spark):
    rnd = random.Random(6)
    rows = [(i, "same  text" if i % 3 == 1 else f"text {rnd.randrange(2000)}", "en", "a", 1) for i in range(6000)]
    docs = frame(spark, rows).repartition(16)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.mark(docs, fan=2).collect()}
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[digest(text)].append(i)
    assert got == {i: (min(g), len(g), i == min(g)) for g in groups.values() for i in g}
    runs = exact_dedup.first_runs(exact_dedup.digests(docs))
    hot = bytes.fromhex(digest("same text"))
    entries = [r for r in exact_dedup._entries(runs).collect() if bytes(r.sha) == hot]
    assert len(entries) <= 16  # one of each partition, however many rows


def test_equal_digests_with_other_checks_stay_apart():
    run = np.zeros((exact_dedup.WIDTH, 4), np.uint64)
    run[exact_dedup.COUNT] = 1
    run[exact_dedup.CHECK] = [1, 2, 1, 1]
    run[exact_dedup.ID] = np.array([5, 4, -3, 9], np.int64).view(np.uint64)
    run[exact_dedup.NULL] = [0, 0, 1, 0]
    out = exact_dedup.merged([run[:, :2], run[:, 2:]])
    assert out[exact_dedup.CHECK].tolist() == [1, 2] and out[exact_dedup.COUNT].tolist() == [3, 1]
    assert out[exact_dedup.ID].view(np.int64).tolist() == [5, 4]


def test_rounds():
    assert exact_dedup.rounds_of(1) == (2, 1) and exact_dedup.rounds_of(8) == (8, 1)
    for places in (2, 9, 51, 64, 65, 4000):
        fan, rounds = exact_dedup.rounds_of(places)
        assert fan <= exact_dedup.FAN and fan**rounds >= places


# --- conversation repair ---------------------------------------------------------------------


def following(roles):
    return "a" if roles.endswith("u") else "u"


def best_of_all(codes):
    """(audit, cost) among all strings of edits, up to three insertions in a row."""
    found = []
    gaps = ["", "I", "II", "III"]
    for edits in itertools.product("DKR", repeat=len(codes)):
        for more in itertools.product(gaps, repeat=len(codes) + 1):
            audit = more[0] + "".join(e + g for e, g in zip(edits, more[1:]))
            roles, cost, rows = "", 0, iter(codes)
            for e in audit:
                if e == "I":
                    roles, cost = roles + following(roles), cost + 3
                    continue
                initial, fault = divmod(next(rows), 4)
                if e == "D":
                    cost += 4
                    continue
                if fault >= 2:
                    roles = "-"
                cost += (3 if fault == 1 else 0) + (3 if e == "R" else 0)
                roles += following(roles) if e == "R" else "sua-"[initial]
            if re.fullmatch("(s?(ua)+)?", roles):
                found.append((cost, audit))
    cost, audit = min(found)
    return audit, cost


def best_by_table(codes):
    """The same with the cheapest, ASCII-least string of every state after every row."""
    states = {"": (0, "")}

    def inserted(states):
        out = dict(states)
        for state, (cost, audit) in states.items():
            for _ in range(2):
                state, cost, audit = following(state), cost + 3, audit + "I"
                out[state] = min(out.get(state, (cost, audit)), (cost, audit))
        return out

    for code in codes:
        initial, fault = "sua-"[code // 4], code % 4
        after = {}
        for state, (cost, audit) in inserted(states).items():
            ways = [(state, 4, "D")]
            if fault < 2:
                ways.append((following(state), 3 + 3 * fault, "R"))
                if initial == following(state) or (initial == "s" and state == ""):
                    ways.append((initial, 3 * fault, "K"))
            for to, more, edit in ways:
                way = (cost + more, audit + edit)
                after[to] = min(after.get(to, way), way)
        states = after
    ends = inserted(states)
    cost, audit = min(ends[q] for q in ("", "a") if q in ends)
    return audit, cost


def test_repair_is_the_best_of_all():
    rnd = random.Random(1)
    for _ in range(150):
        codes = bytes(rnd.randrange(16) for _ in range(rnd.randrange(4)))
        assert best_of_all(codes) == best_by_table(codes) == conversation_repair.repair_rows(codes)


def test_long_repairs_equal_the_full_table():
    rnd = random.Random(2)
    pools = [range(16), [0, 4, 8], [4, 8, 5, 9], [2, 3, 6], [0, 0, 0, 4], [12, 13]]
    for _ in range(800):
        codes = bytes(rnd.choices(rnd.choice(pools), k=rnd.randrange(80)))
        assert best_by_table(codes) == conversation_repair.repair_rows(codes)
    codes = bytes(rnd.randrange(16) for _ in range(20_000))
    assert best_by_table(codes) == conversation_repair.repair_rows(codes)


def test_stretches_cross_like_rows():
    """Summed stretches of any lengths give the audit of the whole sequence."""
    rnd = random.Random(3)
    for _ in range(200):
        rows = rnd.choices(range(16), k=rnd.randrange(1, 60))
        solver, ends = conversation_repair.Solver(), sorted(rnd.sample(range(1, len(rows) + 1), rnd.randrange(len(rows)))) + [len(rows)]
        cut = [rows[a:b] for a, b in zip([0, *ends], ends) if b > a]
        steps = [solver.summed(part) for part in cut]
        end = solver.end(steps)
        states = [0, *solver.crossings(steps, 0, end)]
        audit = "".join(solver.audit(p, a, b)[0] for p, a, b in zip(cut, states, states[1:]))
        assert audit + conversation_repair.CLOSING[end] == best_by_table(rows)[0]


def repaired(rows):
    """What the contract says of (conv_id, turn, role, text), by the full table."""
    blank = lambda x: " " if x is None else str(x)
    by = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        draw = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        by[conv] += [(turn, "user" if draw == 4 else role, text)] * {0: 0, 3: 2}.get(draw, 1)
    out = {}
    for conv, own in by.items():
        key = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], key(r)))
        seen, codes = set(), []
        for _, role, text in own:
            shown = text.strip(" \t\n\v\f\r")
            fault = 2 if not shown else 3 if (role, text) in seen else 0 if shown[-1] in ".!?" else 1
            seen.add((role, text))
            codes.append(("sua".find(role[0]) if role and role[0] in "sua" else 3) * 4 + fault)
        audit, cost = best_by_table(codes)
        lines, turns, roles = [], iter(own), ""
        for e in audit:
            role, text = ("", "") if e == "I" else next(turns)[1:]
            if e != "D":
                role = role if e == "K" else "assistant" if roles.endswith("u") else "user"
                roles += role[0]
                lines.append(f"{role}:{text}")
        known = [t for t, _, _ in own if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        faults = Counter(c % 4 for c in codes)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, faults[2], faults[3], faults[1], illegal, cost, audit, sha)
    return out


TURNS = "conv_id long, turn long, role string, text string"


def reports(conversations):
    turns = conversation_repair.damaged(conversations)
    plans = conversation_repair.audits(turns, conversations)
    return {r[0]: tuple(r)[1:] for r in conversation_repair.with_digest(turns, plans).collect()}


def odd_conversations():
    """A conversation with most rows, over many partitions; nulls, ties, repeats, other roles."""
    rnd = random.Random(5)
    roles = ["user", "assistant", "assistant", "user", "system", None, "tool", ""]
    texts = ["Hello.", "ok", "what?", "", " \t", None, "Sure! ", "no end\n", "yes.", *[f"line {i}." for i in range(60)]]
    rows = [(1, i // 2 if i % 7 else None, rnd.choice(roles), rnd.choice(texts)) for i in range(2500)]
    rows += [(i, j, ("user", "assistant")[j % 2], f"t{i} {j}.") for i in range(2, 60) for j in range(rnd.randrange(5))]
    return rows + [(None, None, None, None), (None, 2, "user", "x."), (77, None, "system", "s.")] + [(88, 1, "user", "same.")] * 400


def test_conversations_equal_brute_force(spark):
    rows = odd_conversations()
    conversations = spark.createDataFrame(rows, TURNS).repartition(8)
    assert reports(conversations) == repaired(rows)
    given = table(spark, SMALL, "conversations")
    assert {r[0]: tuple(r)[1:] for r in QUERIES["op13_conversation_repair"](spark, SMALL).collect()} == repaired(list(map(tuple, given.collect())))
    assert reports(conversations.limit(0)) == {}


def test_repaired_turns_are_legal(spark):
    conversations = spark.createDataFrame(odd_conversations(), TURNS)
    turns = conversation_repair.damaged(conversations)
    plans = conversation_repair.audits(turns, conversations)
    texts = defaultdict(list)
    for r in sorted(conversation_repair.repaired_turns(turns, plans).collect(), key=lambda r: r.place):
        texts[r.conv_id].append(r)
    audit = {r.conv_id: r.audit for r in plans.collect()}
    for conv, own in texts.items():
        assert re.fullmatch("s?(ua)+", "".join(r.role[0] for r in own))
        assert "".join(r.edit for r in own) == audit[conv].replace("D", "")
        assert [r.place for r in own] == list(range(len(own)))


def test_conversations_with_clashing_columns(spark):
    rows = [("c", 0, "user", "a.", 1, "x"), ("c", 1, "assistant", "b.", 2, "y"), ("d", 0, "user", "a.", 3, None)]
    turns = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string, cost int, audit string")
    plans = conversation_repair.audits(turns)
    got = {r.conv_id: (r.audit, r.cost) for r in conversation_repair.with_digest(turns, plans).collect()}
    assert got == {"c": ("KK", 0), "d": ("KI", 3)}
