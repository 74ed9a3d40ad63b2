"""Structure repair, filter audit and SimHash groups against plain Python versions, with every odd case."""

import hashlib
import heapq
import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallymark.llm import filter_audit, repair, simhash
from tallymark.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import article

TURNS = "conv_id bigint, turn bigint, role string, text string"
BLANK = " \t\n\v\f\r"

# Structure repair


def repaired(rows):
    """The contract for one conversation: rows (turn, role, text) in order after damage."""
    seen, kinds = set(), []
    for _, role, text in rows:
        bare = text.strip(BLANK)
        kinds.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    # Shortest way over (row, output so far as a state), with any number of insertions.
    ends, done, todo = [], set(), [(0, "", 0, "", ())]
    while todo:
        cost, audit, i, state, lines = heapq.heappop(todo)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            ends.append((cost, audit, lines))
        due = "a" if state == "u" else "u"
        name = {"a": "assistant", "u": "user"}[due]
        out = [(3, "I", i, due, (f"{name}:",))]
        if i < len(rows):
            _, role, text = rows[i]
            out.append((4, "D", i + 1, state, ()))
            if kinds[i] not in ("blank", "duplicate"):
                more = 3 if kinds[i] == "truncated" else 0
                out.append((3 + more, "R", i + 1, due, (f"{name}:{text}",)))
                if role[:1] == due or (role[:1] == "s" and state == ""):
                    out.append((more, "K", i + 1, role[:1], (f"{role}:{text}",)))
        for c, letter, j, to, line in out:
            heapq.heappush(todo, (cost + c, audit + letter, j, to, lines + line))
    cost, audit, lines = min(ends)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    ), list(lines)


def conversations(table, damage=True):
    """conv -> rows after damage, in order."""
    out = defaultdict(list)
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        text = "" if draw == 1 else text.translate({ord(c): None for c in ".!?"}) if draw == 2 else text
        out[conv] += [(turn, "user" if draw == 4 else role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    return {c: sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, rows in out.items()}


def found(rows):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r["conv"]: tuple(r[n] for n in names) for r in rows}


def odd_conversations():
    rng = random.Random(5)
    roles = ["system", "user", "assistant", "assistant", "user", "tool", "", " ", None, "Ünbekannt"]
    texts = ["Fine.", "cut off", "Fine.", "", " \n", None, "Why?  ", "é!", "word. more", "x" * 3_000 + "."]
    rows = [(c, rng.choice([None, 0, 1, 2, 3, 5, 5, 9, 40]), rng.choice(roles), rng.choice(texts)) for c in [*range(160), None] for _ in range(rng.randint(1, 7))]
    rows += [(900, t, "user" if t % 2 else "assistant", f"turn {t}" + ("." if t % 3 else "")) for t in range(400)]
    rows += [(901, 7, "user", "again.")] * 300 + [(901, t, "assistant", "again.") for t in range(300)]
    return rows


def test_repair_equals_shortest_ways(spark):
    table = odd_conversations()
    turns = spark.createDataFrame(table, TURNS).withColumn("copies", F.lit("clash")).repartition(5)
    got = found(repair.audits(repair.blocks(repair.damaged(turns))).collect())
    want = {c: repaired(rows)[0] for c, rows in conversations(table).items()}
    assert set(got) == {r[0] for r in table}
    for conv, row in want.items():
        assert got[conv] == row, conv


def test_repair_in_small_blocks_and_its_turns(spark):
    table = [r for r in odd_conversations() if r[0] is None or r[0] < 60 or r[0] >= 900]
    turns = spark.createDataFrame(table, TURNS).select(F.col("conv_id").alias("conv"), "turn", "role", "text", F.lit(1).alias("copies"))
    parts = repair.written(repair.blocks(turns, block=3))
    assert parts.groupBy("conv").count().agg(F.max("count")).first()[0] > 100
    want = {c: repaired(rows) for c, rows in conversations(table, damage=False).items()}
    assert found(repair.audits(parts).collect()) == {c: w[0] for c, w in want.items()}
    lines = defaultdict(list)
    for r in repair.repaired_turns(parts).orderBy("conv", "turn").collect():
        assert r["turn"] == len(lines[r["conv"]])
        lines[r["conv"]].append(f"{r['role']}:{r['text']}")
    assert {c: lines.get(c, []) for c in want} == {c: w[1] for c, w in want.items()}


def test_repair_of_dropped_and_of_no_conversations(spark):
    gone = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    turns = spark.createDataFrame([(gone, 0, "user", "Hi.")], TURNS)
    assert found(repair.audits(repair.blocks(repair.damaged(turns))).collect()) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert repair.audits(repair.blocks(repair.damaged(turns.limit(0)))).count() == 0


def test_transfers_decide_ties_by_letters():
    # An assistant turn first: delete (4), insert before (3) or make it the user's and insert after (6).
    assert repair.transfers("a")[repair.ASSISTANT][repair.NOTHING] == (3, "IK")
    # A lone truncated user turn: deleting costs 4, keeping it 3 and 3 for the answer.
    assert repair.transfers("U")[repair.NOTHING][repair.NOTHING] == (4, "D")
    # Two user turns, then an answer: deleting either costs 4, an answer between 3.
    assert repair.transfers("uua")[repair.ASSISTANT][repair.NOTHING] == (3, "KIKK")
    for rows in map("".join, itertools.product("suaxd", repeat=3)):
        for line in repair.transfers(rows):
            assert all(w is None or len(w[1].replace("I", "")) == 3 for w in line)


# Filter audit


def audited(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    first = {}
    for key, text, _ in docs:
        if key is not None:
            first[text or ""] = min(key, first.get(text or "", key))
    good, toxic = ({k for k, q, t in labels if (q, t)[i] == 1} for i in (0, 1))
    rows = []
    for key, text, source in docs:
        text = text or ""
        words = brute.WORD.findall(text)
        fails = {f for f, x in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            any(c in "#$%&*|" for c in text), key is not None and key > first[text],
        )) if x}
        rows.append((source or "", fails, key is not None and key in good, key is not None and key in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        own, shapley = [r for r in rows if r[0] == part], defaultdict(int)
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone, left = [r for r in left if f in r[1]], [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                failing = [r for r in own if f in r[1]]
                out[part, order, step] = [len(left), len(gone), len(failing) - len(gone), sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_filter_audit_equals_brute_force(spark, odd_texts):
    rng = random.Random(3)
    texts = [*odd_texts, *[article(i, 30 + 20 * i) for i in range(14)], article(2, 400).upper(), " ".join(["same"] * 300), article(3, 250) + " | "]
    docs = [(rng.choice([i, i, i - 1, None]), rng.choice(texts), rng.choice(["a", "b", "", None, "long " * 40])) for i in range(160)] + [(5, texts[-1], "a")] * 4
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 160, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string").withColumns({"mask": F.lit("clash"), "n": F.lit(9), "part": F.lit("clash"), "good": F.lit(1)}).repartition(4)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in filter_audit.COUNTS) for r in filter_audit.filter_audit(frame, marks).collect()}
    assert got == audited(docs, labels)
    assert filter_audit.filter_audit(frame.limit(0), marks).count() == 0
    assert filter_audit.filter_audit(frame, marks.limit(0)).agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


def test_long_texts_are_cut_between_words(monkeypatch):
    text = (article(9, 900) + " \n " + "One # two").encode()
    whole = filter_audit.own_failures(text)
    monkeypatch.setattr(filter_audit, "_PIECE", 64)
    assert filter_audit.own_failures(text) == whole


# SimHash


def plain_fingerprint(text):
    words = brute.WORD.findall((text or "").translate(brute.LOWER))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints):
    """Row -> set of rows that can be reached, for a list of fingerprints."""
    root = list(range(len(prints)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return [top(i) for i in range(len(prints))]


def check_groups(rows, got):
    prints = [plain_fingerprint(t) for _, t in rows]
    tops, lowest = grouped(prints), {}
    for (key, _), t in zip(rows, tops):
        if key is not None:
            lowest[t] = min(key, lowest.get(t, key))
    want = sorted(((key, f"{p:016x}", lowest.get(t)) for (key, _), p, t in zip(rows, prints, tops)), key=str)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str) == want


def test_simhash_query_equals_brute_force(spark, data):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    check_groups(rows, QUERIES["op13_simhash_dedup"](spark, data).collect())


def test_simhash_of_odd_texts_repeats_and_nothing(spark, docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows += [(7, "other text with id 7"), (rows[3][0], rows[3][1]), (None, rows[4][1]), (None, "alone and nameless here")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"fp": F.lit("clash"), "path": F.lit(1), "component_id": F.lit(2)}).repartition(3)
    check_groups(rows, simhash.simhash_groups(frame).collect())
    assert simhash.simhash_groups(no_docs).count() == 0


def test_fingerprints_of_long_texts_are_cut_between_words(monkeypatch):
    texts = [article(i, 300) for i in range(3)] + ["a  b", "one\ttwo three", "x" * 500, " " * 500 + "a b c d", "A" * 100 + " " * 200 + "b c " * 60]
    whole = [simhash.fingerprint(t.encode()) for t in texts]
    assert whole == [plain_fingerprint(t) for t in texts]
    for piece in (1, 7, 64):
        monkeypatch.setattr(simhash, "_PIECE", piece)
        assert [simhash.fingerprint(t.encode()) for t in texts] == whole


def near_prints(seed, n, centres, most):
    rng = random.Random(seed)
    middle = [rng.getrandbits(64) for _ in range(centres)]
    out = set()
    for _ in range(n):
        p = rng.choice(middle)
        for b in rng.sample(range(64), rng.randint(0, most)):
            p ^= 1 << b
        out.add(p)
    return sorted(out)


@pytest.mark.parametrize("limit", [simhash.LIMIT, 20])
def test_links_lose_nothing_in_hot_buckets(spark, limit):
    rng = random.Random(2)
    prints = near_prints(1, 600, 3, 6) + [rng.getrandbits(64) for _ in range(50)]
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp bigint"), limit).collect()
    at = {p: i for i, p in enumerate(signed)}
    label = simhash.merged(np.arange(len(prints)), np.array([at[e["a"]] for e in edges]), np.array([at[e["b"]] for e in edges]))
    assert label.tolist() == grouped(prints)


def test_bit_slices_count_distances():
    prints = np.array(near_prints(4, 300, 2, 5), np.uint64)
    planes = simhash.bit_planes(prints)
    queries = prints[::7]
    for word in range(planes.shape[1]):
        found = simhash.within_three(queries, np.full(len(queries), word), planes, tuple(range(64)))
        for q, bits in zip(queries.tolist(), found.tolist()):
            for lane, p in enumerate(prints[64 * word : 64 * word + 64].tolist()):
                assert bool(bits >> lane & 1) == ((q ^ p).bit_count() <= 3)


def test_three_cuts_bound_a_bucket():
    def sizes(free, level):
        return len(free) if not level else max(sizes(tuple(b for b in free if b not in set(w)), level - 1) for w in simhash.ways(free))

    assert 1 << sizes(tuple(range(64)), simhash.LEVELS) <= simhash.LIMIT
    for free in (tuple(range(64)), simhash.free_bits(103)):
        for three in itertools.combinations(free[:: max(1, len(free) // 12)], 3):
            assert any(not set(three) & set(w) for w in simhash.ways(free))


# Extraction: names of elements are no verdict on the frame of a page


def para(word, n=12):
    return "<p>" + " ".join(f"{word}{i} some words, and more." for i in range(n)) + "</p>"


def plain(html_text):
    import re

    return [" ".join(re.sub("<[^>]*>", "", b).split()) for b in re.split("</?(?:p|h1|div|article|html|body)[^>]*>", html_text) if b.strip()]


STORY = "".join(para(f"s{i}") for i in range(6))
ASIDE = "<nav><a>Home</a></nav><div class='sidebar'><p>side links, many of them.</p></div><div id='cookie-notice'><p>We use cookies.</p></div><footer>foot</footer>"


@pytest.mark.parametrize("before, inside, after", [
    ("<div class='site has-sidebar'>" + ASIDE + "<article>", "<h1>Head</h1>" + STORY, "</article></div>"),
    (ASIDE + "<div class='post no-comments'>", "<h1>Head</h1>" + STORY, "</div>"),
    (ASIDE + "<div id='research-and-search'>", STORY, "</div>"),
    ("<div class='site has-sidebar'><div class='content no-comments'>" + ASIDE, STORY, "</div></div>"),
    (ASIDE + "<article>", "<div class='entry-header'><h1>Head</h1></div>" + STORY, "</article>"),
    ("<div class='header'><h1>Site</h1></div><article>", "<h1>Head</h1>" + STORY, "</article><div class='comments'>" + "".join(para(f"c{i}", 20) for i in range(20)) + "</div>"),
    (ASIDE, "<div>" + "".join(para(f"intro{i}") for i in range(3)) + "<div>" + STORY + "</div></div>", ""),
])
def test_frames_with_boilerplate_names_keep_their_story(spark, before, inside, after):
    from tallymark.llm import extraction

    page = spark.createDataFrame([(1, "<html><body>" + before + inside + after + "</body></html>")], "page_id bigint, html string")
    assert extraction.main_text(page).first()["text"].split("\n") == plain(inside)
