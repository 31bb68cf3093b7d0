"""Nearest vectors, repaired conversations and phrases: edge cases and brute force."""

import hashlib
import itertools
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradelens.llm import ann, conversations, html_tree, phrases, sharding

VECTORS = "vec_id long, embedding array<double>, point long, cell int, v string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 0, "x") for i, v in rows], VECTORS)


def brute_nearest(rows, queries, k):
    """Sequential search over one row per id."""
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            v = tuple(float(x) for x in v)
            usable[i] = min(usable.get(i, v), v)
    out = []
    for q in sorted(set(queries) & set(usable)):
        near = sorted((float(np.sqrt(((np.array(v) - usable[q]) ** 2).sum())), i) for i, v in usable.items() if i != q and len(v) == len(usable[q]))
        out += [(q, r + 1, i, s) for r, (s, i) in enumerate(near[:k])]
    return out


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_nearest_of_odd_rows_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(40)]
    rows += [(40 + i, rows[3][1]) for i in range(30)]  # copies of one vector: ties by id
    rows += [(100, None), (101, []), (102, [0.0] * 6), (103, [None] + [1.0] * 5), (104, [float("nan")] + [1.0] * 5), (105, [float("inf")] + [1.0] * 5), (None, [1.0] * 6)]
    rows += [(200, [1.0]), (201, [2.0]), (202, [-0.0, 1.0, 2.0]), (5, rows[5][1]), (6, [9.0] * 6)]
    ids = [i for i, _ in rows if i is not None]
    df = vectors_of(spark, rows)
    got = found(ann.nearest(df, df, 10, target=1.0))
    want = brute_nearest(rows, ids, 10)
    assert [g[:3] for g in got] == [w[:3] for w in want] and np.allclose([g[3] for g in got], [w[3] for w in want])
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0 and ann.nearest(df, df.limit(0)).count() == 0


@pytest.mark.parametrize("clustered", [False, True])
def test_nearest_reach_the_recall(spark, clustered):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 16)) + (rng.normal(size=(30, 16)) * 8)[rng.integers(0, 30, 3000)] * clustered
    x[:1000] = x[0] + rng.normal(size=(1000, 16)) * 1e-3  # a third of the rows in one place
    rows = list(enumerate(x.tolist()))
    df = vectors_of(spark, rows)
    got = ann.nearest(df, df.where("vec_id % 20 = 0")).collect()
    want = {(q, i) for q, _, i, _ in brute_nearest(rows, range(0, 3000, 20), 10)}
    assert len(got) == len(want) and len({(r.query_id, r.vec_id) for r in got} & want) >= 0.9 * len(want)


def test_cells_come_by_ascending_sum():
    rng = np.random.default_rng(3)
    index = ann.MultiIndex(rng.normal(size=(7, 2)), rng.normal(size=(5, 3)))
    index.held[:] = rng.integers(0, 3, 35)
    a, b = (d[0] for d in index.halves(rng.normal(size=(1, 5))))
    cells = [c for c, _ in index.walk(a, b)]
    sums = (a[:, None] + b).ravel()
    assert sorted(cells) == np.flatnonzero(index.held).tolist() and (np.diff(sums[cells]) >= 0).all()
    assert [n for _, n in index.walk(a, b)] == np.concatenate([[0], np.cumsum(index.held[cells])[:-1]]).tolist()


ROWS = "conv_id long, turn long, role string, text string, part int, kind string"


def faults_of(rows):
    """First fault of each row of one conversation."""
    out, seen = [], set()
    for role, text in rows:
        body = text.strip(" \t\n\x0b\f\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def brute_repair(rows):
    """All edit sequences with up to two inserts in a gap: least cost, then least audit."""
    faults, best = faults_of(rows), None
    gaps = ["", "I", "II"]
    for edits in itertools.product("KRD", repeat=len(rows)):
        if any(f in ("blank", "duplicate") and e != "D" for f, e in zip(faults, edits, strict=True)):
            continue
        for inserts in itertools.product(gaps, repeat=len(rows) + 1):
            audit = "".join(i + e for i, e in zip(inserts, [*edits, ""], strict=True))
            cost = sum({"K": 0, "R": 3, "D": 4, "I": 3}[e] for e in audit) + sum(3 for f, e in zip(faults, edits, strict=True) if f == "truncated" and e != "D")
            if best and (cost, audit) >= best[:2]:
                continue
            out, at = [], 0
            for e in audit:
                due = "assistant" if out and out[-1][0][:1] == "u" else "user"
                if e == "I":
                    out.append((due, ""))
                else:
                    role, text = rows[at]
                    at += 1
                    out += [] if e == "D" else [(role if e == "K" else due, text)]
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in out)):
                best = (cost, audit, out)
    return best


def brute_report(conv_id, rows):
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
    pairs = [(r, x) for _, r, x in rows]
    turns = [t for t, _, _ in rows if t is not None]
    kinds = Counter(faults_of(pairs))
    illegal = sum((a[:1] + b[:1]) not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(pairs))
    cost, audit, out = brute_repair(pairs)
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest()
    return (conv_id, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds["blank"], kinds["duplicate"], kinds["truncated"], illegal, cost, audit, digest)


def conversations_of(rng, n):
    out = {}
    for c in [*range(n), None]:
        out[c] = [(rng.choice([None, 0, 1, 2, 3, 7]), rng.choice(["system", "user", "assistant", "user", "assistant", None, "tool", ""]), rng.choice(["Yes.", "no", "", " \t", "Why? ", None, "é…", "ok!"])) for _ in range(rng.randrange(1, 5))]
    return out


@pytest.mark.parametrize("part_rows", [256, 2])
def test_repairs_equal_all_edit_sequences(spark, monkeypatch, part_rows):
    monkeypatch.setattr(conversations, "PART_ROWS", part_rows)
    talks = conversations_of(random.Random(part_rows), 40)
    rows = [(c, *r, 1, "x") for c, own in talks.items() for r in own]
    df = spark.createDataFrame(rows, ROWS)
    got = {r.conv_id: tuple(r) for r in conversations.repair_reports(df).collect()}
    assert got == {c: brute_report(c, own) for c, own in talks.items()}
    turns = conversations.repaired_turns(df).collect()
    for c in talks:
        own = sorted((r.place, r.role, r.text) for r in turns if r.conv_id == c)
        assert [p for p, _, _ in own] == list(range(len(own)))
        assert hashlib.sha256("\n".join(f"{r}:{x}" for _, r, x in own).encode()).hexdigest() == got[c][-1]
    assert conversations.repair_reports(df.limit(0)).count() == 0


def test_dropped_and_long_conversations(spark):
    long = [(1, k, "user" if k % 2 == 0 else "assistant", f"Turn {k}.", False) for k in range(1500)]
    gone = [(2, k, "user", "Hello.", True) for k in range(3)]
    df = spark.createDataFrame(long + gone, "conv_id long, turn long, role string, text string, dropped boolean")
    got = {r.conv_id: r for r in conversations.repair_reports(df).collect()}
    assert got[1].audit == "K" * 1500 and got[1].cost == 0 and got[1].gaps == 0
    assert tuple(got[2])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_nodes_of_the_automaton_are_shared():
    automaton = conversations.SuffixAutomaton()
    signatures = sorted(["uauaua", "auaua", "suaua", "uaUaua", "xauaua"], key=lambda s: s[::-1])
    for s in signatures:
        automaton.ways(s)
    ends = {s[k:] for s in signatures for k in range(len(s))}
    assert automaton.made == len(ends)


def brute_collocations(docs, least, longest, top, covered):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", low):
            words = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    frequent = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    most = Counter()
    for (lang, p), a in frequent.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                most[lang, p[i : i + k]] = max(most[lang, p[i : i + k]], a)
    out = {}
    for (lang, p), a in frequent.items():
        if 100 * most[lang, p] < covered * a:
            score, _, left, right = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, b" ".join(p), left, right))
    return sorted((lang, r + 1, p.decode(), -a, left, right, n[lang], -s) for lang, rows in out.items() for r, (s, a, p, left, right) in enumerate(sorted(rows)[:top]))


def talk(rng, n):
    """Texts over few words, so phrases repeat, with odd blanks and breaks."""
    words = ["a", "A", "bb", "Cé", "d-d", "…", "中文", "zz"]
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "\x0b"]) for _ in range(n))


def test_collocations_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 300)
    monkeypatch.setattr(phrases, "HELD", 50)
    rng = random.Random(5)
    docs = [(rng.choice(["en", "de", None, ""]), talk(rng, rng.randrange(0, 200))) for _ in range(60)]
    docs += [("en", None), ("en", ""), ("en", " \t\n."), ("fr", "bb bb " * 400), ("fr", "bb bb " * 400), ("en", "a bb\tzz " * 300)]
    df = spark.createDataFrame([(k, t, lang, 1, "x") for k, (lang, t) in enumerate(docs)], "doc_id long, text string, lang string, key int, phrase string")
    got = sorted(tuple(r) for r in phrases.collocations(df, 8, 4, 25, 80).collect())
    assert got == brute_collocations(docs, 8, 4, 25, 80) and len(got) > 60
    assert phrases.collocations(df.limit(0)).count() == 0


def test_colliding_fingerprints_never_change_counts(spark, monkeypatch):
    """All fingerprints fall on 64 values; blocks are hashed in this process, as monkeypatches do not reach workers."""
    rng = random.Random(6)
    monkeypatch.setattr(phrases, "mix", lambda x: x & np.uint64(63))
    block = phrases.Block([(talk(rng, 300).encode(), "en", 0), (talk(rng, 300).encode(), "de", 0)])
    words = [block.low[s:e].tobytes() for s, e in zip(block.starts, block.ends, strict=True)]
    number = block.exact_words()
    assert len(set(number.tolist())) == len(set(words)) == len(set(zip(number.tolist(), words, strict=True)))

    class Everything:
        class value:
            passes = staticmethod(lambda keys: np.ones(len(keys), bool))

    import pyarrow as pa

    docs = [("en", talk(rng, 300)), ("de", talk(rng, 300))]
    batch = pa.record_batch([pa.array([d[0] for d in docs]), pa.array([d[1] for d in docs])], names=["lang", "text"])
    got = Counter()
    for b in phrases._gathered(1)(phrases._written(2, Everything, 5)([batch])):
        for lang, n, p, c in zip(*[b.column(k).to_pylist() for k in ("lang", "words", "phrase", "count")], strict=True):
            got[lang, n, p] += c
    want = Counter()
    for lang, text in docs:
        low = text.encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))
        for piece in re.split(rb"[.,;:!?\x0a-\x0d]", low):
            own = piece.split()
            want[lang, 0, ""] += len(own)
            for k in (1, 2):
                want.update((lang, k, b" ".join(own[i : i + k]).decode()) for i in range(len(own) - k + 1))
    assert got == want


def test_sections_of_a_text_without_breaks_repeat_words(monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 50)
    text = " ".join(f"w{k % 7}" for k in range(200)).encode()
    grams = Counter()
    for part in phrases._sections(text, "en", 3):
        words = part[0].split()
        grams.update(tuple(words[i : i + n]) for n in range(1, 5) for i in range(len(words) - n + 1) if i + n > part[2])
    words = text.split()
    assert grams == Counter(tuple(words[i : i + n]) for n in range(1, 5) for i in range(len(words) - n + 1))


def brute_shards(rows, limit):
    """Split only buckets above the limit, bit by bit."""
    out, pending = {}, [("", rows)]
    while pending:
        prefix, own = pending.pop()
        if sum(n for _, n, _ in own) <= limit or len({k for _, _, k in own}) == 1:
            out |= {row: prefix for row, _, _ in own}
            continue
        bit = sharding.KEY_BITS - 1 - len(prefix)
        for b in "01":
            if half := [r for r in own if r[2] >> bit & 1 == int(b)]:
                pending.append((prefix + b, half))
    return out


@pytest.mark.parametrize("limit", [100, 3000, 10**6])
def test_only_oversized_buckets_split(spark, limit):
    rng = random.Random(limit)
    rows = [(k, rng.randrange(0, 90), rng.getrandbits(sharding.KEY_BITS) if k % 5 else 7 << 50 | k % 3) for k in range(400)]
    df = spark.createDataFrame([(k, n, k, key) for k, n, key in rows], f"doc_id long, n_bytes long, {sharding.ROW} long, key long")
    got = {r.doc_id: r.shard for r in sharding._assigned(df, limit).collect()}
    assert got == {k: f"{len(p)}:{p}" for k, p in brute_shards(rows, limit).items()}


def test_written_shards_hold_every_row_once(spark, tmp_path):
    rows = [(1, "a" * 30), (1, "b" * 30), (None, "c" * 30), (2, "d" * 30), (2, "d" * 30), (3, None), (None, "")]
    df = spark.createDataFrame([(i, t, "own") for i, t in rows], "doc_id long, text string, shard string")
    assignment = sharding.write_shards(df, str(tmp_path / "shards"), 40)
    back = spark.read.parquet(str(tmp_path / "shards"))
    key = lambda r: tuple(map(str, r))
    assert sorted([(r.doc_id, r.text, r.doc_shard) for r in back.collect()], key=key) == sorted([(i, t, "own") for i, t in rows], key=key)
    sizes = {r.shard: r.shard_bytes for r in assignment.collect()}
    assert max(sizes.values()) <= 40 and {r.shard: r.n for r in back.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("n")).fillna(0).collect()} == sizes
    sharding.write_shards(df.limit(0), str(tmp_path / "none"), 40)
    assert spark.read.schema(back.schema).parquet(str(tmp_path / "none")).count() == 0


def test_unclosed_tags_are_read_in_time_that_grows_with_the_page():
    n = 30_000
    for page in ("<b>" * n + "<p>x" * n, "<b>" * n + "</i>" * n, "<b><div>" + "<i>" * n + "</b>" * n, "<li><p>" + "<option>" * n + "<p>" * n):
        begun = time.process_time()
        html_tree.parse(page)
        assert time.process_time() - begun < 10
