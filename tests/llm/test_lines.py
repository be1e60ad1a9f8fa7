import random

from sojourn.llm import lines as L
from tests.harness import compare, duck

LINE = "A b c d e f g h i j"
ROWS = [(2, f"{LINE}\nx\n{LINE}  k"), (1, f"q\n{LINE.lower()}\r\nz\n{LINE}"), (3, None), (4, ""), (None, LINE), (2, LINE), (5, f"{LINE}\n{LINE}"), (6, "x\nx\nx"), (7, f"😀{LINE} é\nu\n😀{LINE} É"), (8, f"end\n😀{LINE} é")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "r") for i, t in rows], "doc_id long, text string, removed string").repartition(3)


def cut(line, least):
    """Spans (start, end, words) of a line that may go: units, and inside them the long sentence, what
    leads it and what follows it; written as a plain scan."""
    ends = [i + 1 for i in range(len(line) - 1) if line[i] in " \t" and line[i + 1] not in " \t" and line[:i + 1].rstrip(" \t")[-1:] in tuple(".!?")]
    edges = [0, *ends, len(line)] if line else []
    words = lambda a, z: [w for w in line[a:z].translate(L._FOLD).split(" ") if w]
    parts = list(zip(edges, edges[1:]))
    longs = [p for p in parts if len(words(*p)) >= least]
    starts = [0, *(a for a, _ in longs[1:]), len(line)] if line else []
    out = []
    for u, (a, z) in enumerate(zip(starts, starts[1:])):
        spans = {(a, z)}
        if longs:
            b, c = longs[u]
            spans |= {(a, b), (b, c), (c, z)}
        out += [(x, y, words(x, y)) for x, y in spans if x < y]
    return out


def brute(rows, least=L.MIN_WORDS):
    ranked = []
    for n, (i, t) in enumerate(rows):
        at = 0
        for line in (t or "").split("\n"):
            ranked += [(i is None, i or 0, at + a, n, at + z, " ".join(w)) for a, z, w in cut(line, least) if len(w) >= least]
            at += len(line) + 1
    seen, gone = set(), {}
    for none, i, a, n, z, unit in sorted(ranked):
        if unit in seen:
            gone.setdefault(n, []).append((a, z))
        seen.add(unit)
    out = []
    for n, (_, t) in enumerate(rows):
        lost, lines, at = {k for a, z in gone.get(n, ()) for k in range(a, z)}, [], 0
        for line in (t or "").split("\n"):
            own = range(at, at + len(line))
            left = "".join(c for k, c in zip(own, line) if k not in lost)
            if not line or any(k not in lost for k in own):
                lines.append(left.rstrip(" \t") if lost & set(own) else left)
            at += len(line) + 1
        out.append(None if t is None else "\n".join(lines))
    return out


def test_against_brute_force(spark):
    rows = [r for r in ROWS if r != (2, LINE)]  # rows that repeat an id may tie; see below
    got = L.dedup(frame(spark, rows)).collect()
    assert sorted(repr((r.doc_id, r.text)) for r in got) == sorted(repr((i, t)) for (i, _), t in zip(rows, brute(rows)))
    text = dict((i, t) for i, t in rows)
    for r in got:
        left = "".join(("\n" if n and "\n" in text[r.doc_id][r.kept[n - 1].end: s.start] else "") + text[r.doc_id][s.start: s.end] for n, s in enumerate(r.kept))
        assert left == (r.text or "").strip("\n")
        for s in r.removed:
            assert s.first_doc_id is not None and len(text[r.doc_id][s.start: s.end].split()) >= L.MIN_WORDS


def test_a_passage_inside_lines(spark):
    passage = "One two three four five six seven eight. Nine. Ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen!"
    rows = [(1, f"Mine. A first text of its own with nine words. {passage}"), (2, f"Quite another beginning with as many words as needed. {passage}\nend"),
            (3, passage), (4, f"{passage}  A tail that no other document has in it here."), (5, "Nine. Ten."), (6, "one two three four five six seven eight.\tnine.")]
    assert brute(rows)[1:] == ["Quite another beginning with as many words as needed.\nend", "", "A tail that no other document has in it here.", "Nine. Ten.", ""]
    got = {r.doc_id: r.text for r in L.dedup(frame(spark, rows)).collect()}
    assert got == {i: t for (i, _), t in zip(rows, brute(rows))}


def test_a_repeated_sentence_goes_whatever_stands_beside_it(spark):
    long = " ".join(f"w{k}" for k in range(60)) + "."
    run = "One two three. Four five six. Seven eight nine."
    rows = [(1, f"{long} Yes."), (2, f"{long} Another sentence which is long enough to be one."), (3, f"No. {long} Perhaps."), (4, long), (5, f"No. {long} Perhaps."),
            (6, f"A sentence of its own with all its words. {run}"), (7, f"Here is one more that no other text has. {run}"), (8, f"Yes. No.\n{run}")]
    want = [f"{long} Yes.", "Another sentence which is long enough to be one.", "No. Perhaps.", "", "", rows[5][1], "Here is one more that no other text has.", "Yes. No."]
    assert brute(rows) == want
    got = {r.doc_id: r for r in L.dedup(frame(spark, rows)).collect()}
    assert [got[i].text for i in range(1, 9)] == want
    assert [(s.start, s.end, s.first_doc_id) for s in got[3].removed] == [(4, 4 + len(long) + 1, 1)]
    assert [(s.start, s.end, s.first_doc_id) for s in got[5].removed] == [(0, len(rows[4][1]), 3)]


def test_random_texts(spark):
    rng = random.Random(3)
    sentences = [" ".join(rng.choice("abcdefghij") for _ in range(rng.choice([1, 2, 7, 8, 9, 14]))) + rng.choice([".", "!", "?", ""]) for _ in range(12)]
    rows = [(i, "\n".join(rng.choice([" ", "  ", "\t"]).join(rng.choice(sentences) for _ in range(rng.randint(0, 4))) for _ in range(rng.randint(0, 4)))) for i in range(40)]
    assert {r.doc_id: r.text for r in L.dedup(frame(spark, rows)).collect()} == {i: t for (i, _), t in zip(rows, brute(rows))}


def test_a_tie_keeps_one_occurrence(spark):
    got = L.dedup(frame(spark, [(2, LINE), (2, LINE), (None, LINE), (None, LINE)])).collect()
    assert sorted(r.text for r in got) == ["", "", "", LINE]
    assert next(r for r in got if r.text).doc_id == 2
    assert L.dedup(frame(spark).limit(0)).count() == 0


def test_query_equals_oracle(spark):
    ok, message = compare(L.op6_line_dedup(spark, "/root/testdata/sf0.001"), duck("/root/testdata/sf0.001"), L.ORACLE)
    assert ok, message


def test_without():
    assert L.without("a\nb\nc", [(2, 3)]) == ("a\nc", [(0, 1), (4, 5)])
    assert L.without("a\n\nb c", [(0, 1), (3, 5)]) == ("\nc", [(5, 6)])
    assert L.without("a", [(0, 1)]) == ("", [])
    assert L.without("a b", [(2, 3)]) == ("a", [(0, 1)])
