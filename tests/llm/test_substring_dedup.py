"""Passage removal against a plain pass over all units."""

from __future__ import annotations

from retail_strata.llm import substring_dedup as s


def expected(rows, min_words):
    distinct = list(dict.fromkeys(rows))
    ordered = sorted(distinct, key=lambda r: (r[0] is None, r[0] or 0))
    kept: dict[bytes, object] = {}
    for doc, text in ordered:
        for digest, *_ in s.units(text or ""):
            kept.setdefault(digest, doc)
    out = []
    for doc, text in distinct:
        seen, run = set(), []
        for k, (digest, start, end, words) in enumerate([*s.units(text or ""), (None, 0, 0, 0)]):
            if digest is not None and (digest in seen or kept[digest] != doc):
                run.append((start, end, words, kept[digest]))
            else:
                if sum(r[2] for r in run) >= min_words:
                    out.append(
                        (doc, run[0][0], run[-1][1], len(run), sum(r[2] for r in run), run[0][3])
                    )
                run = []
            seen.add(digest)
    return sorted(out, key=str)


def run(df, min_words=6):
    found = s.find_repeats(df, "doc_id", "text", min_words).drop("text_key")
    return sorted((tuple(r) for r in found.collect()), key=str)


PASSAGE = "One two three four. Five six!\nSeven eight nine ten eleven. Ok."


def cases(prose):
    rows = [(1, "Start here. " + PASSAGE + " End there."), (2, "Ünï. " + PASSAGE), (3, PASSAGE)]
    rows += [(4, "ONE  two three\tfour. five six!\n\nother words."), (5, None), (6, ""), (7, " \n. ")]
    rows += [(8, "Again and again and again. Again and again and again. x."), (9, prose(1, 3000))]
    rows += [(10, prose(1, 3000) + " more."), (3, PASSAGE), (None, "Lead. " + PASSAGE)]
    rows += [(20 + k, prose(50 + k, 30)) for k in range(5)]
    return rows


def test_passages_as_by_a_plain_pass(documents, prose):
    rows = cases(prose)
    assert run(documents(rows, clash=True)) == expected(rows, 6)


def test_removal_keeps_everything_else(documents, prose):
    rows = cases(prose)
    df = documents(rows, clash=True)
    repeats = s.find_repeats(df, "doc_id", "text", 6)
    spans: dict = {}
    for doc, start, end, *_ in expected(rows, 6):
        spans.setdefault(doc, []).append((start, end))

    def cut(doc, text):
        if text is None:
            return None
        for start, end in sorted(spans.get(doc, []), reverse=True):
            text = text[:start] + text[end:]
        return text

    got = s.remove(df, "doc_id", "text", repeats)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        ((doc, cut(doc, text)) for doc, text in rows), key=str
    )


def test_short_meetings_stay(documents):
    assert run(documents([(1, "Yes. No. Ok."), (2, "Yes. No. Ok.")]), 20) == []


def test_empty_table(documents):
    assert run(documents([])) == []


def test_short_lines_go_and_chance_meetings_inside_lines_stay(documents, spark):
    from pyspark.sql import functions as F

    line, later = "A short line of six words", "Yes. No.\n"
    rows = [(1, f"Ok. Head one.\n{line}\n{later}"), (2, f"{line}\nOk. Other text\n{later}Ok. x y z")]
    rows += [(3, f"Own words here\n...\n{line}\nOwn\nNo.\nNo. \n...\nEnd"), (4, "no.\n Yes.  no. \nlast")]
    rows += [(5, f"{line}\n" * 3), (6, f"In a row: more. {line.upper()}! Then {line}.")]
    rows += [(7, f"First here: {line}! On and on. {line}. {line}!")]
    rows += [(8, "A short line of six words! Not a whole line.")]
    df = documents(rows)
    got = s.remove(df, "doc_id", "text", s.find_repeats(df, "doc_id", "text", chance=5))
    texts = {r.doc_id: r.text for r in got.select("doc_id", F.col("text")).collect()}
    assert texts[1] == rows[0][1]
    assert texts[2] == " Other text\nOk. x y z"  # the first Ok. is a neighbour of the line that goes
    assert texts[3] == "Own words here\n...\nOwn\nNo.\nEnd"
    assert texts[4].split() == ["last"]
    assert texts[5] == ""
    assert texts[6].startswith("In a row: more.")
    assert "a short line" not in texts[8].lower() and "Not a whole line." in texts[8]


def test_every_later_line_goes(documents, prose):
    lines = [f"{prose(k, 1 + k % 9)}" for k in range(12)]
    rows = [(d, "\n".join([f"only {d}", *lines[d % 5 :], *lines[: d % 7]])) for d in range(6)]
    rows += [(9, "\n.lead\nyes\n.lead\nyes\n"), (10, "yes\n?!\n.lead\nnew")]
    df = documents(rows)
    left = s.remove(df, "doc_id", "text", s.find_repeats(df, "doc_id", "text"))
    seen = set()
    for _, text in sorted((r.doc_id, r.text) for r in left.collect()):
        for line in filter(None, (" ".join(x.lower().split()) for x in text.split("\n"))):
            assert line not in seen
            seen.add(line)
    whole = {" ".join(x.lower().split()) for _, t in rows for x in t.split("\n")} - {""}
    assert whole == seen


def by_the_rule(rows, chance):
    """Passages by a plain pass: sentences of ``chance`` words together, and shorter whole lines."""
    kept, line_kept, lines = {}, {}, {}
    for doc, text in sorted(rows):
        lines[doc] = []
        for line in (text or "").split("\n"):
            name = " ".join(line.lower().split())
            lines[doc].append(name)
            if name.strip(".!? "):
                line_kept.setdefault(name, doc)
        for digest, *_ in s.units(text or ""):
            kept.setdefault(digest, doc)
    out = []
    for doc, text in rows:
        mine, cut, seen, run = s.units(text or ""), set(), set(), []
        for k, (digest, _, _, words) in enumerate([*mine, (None, 0, 0, 0)]):
            if digest is not None and (digest in seen or kept[digest] != doc):
                run.append((k, words))
            else:
                cut |= {j for j, _ in run} if sum(w for _, w in run) >= chance else set()
                run = []
            seen.add(digest)
        at, had = 0, set()
        for line in (text or "").split("\n"):
            inside = [k for k, u in enumerate(mine) if at <= u[1] <= at + len(line) and u[1] < at + len(line)]
            name = " ".join(line.lower().split())
            if inside and sum(mine[k][3] for k in inside) < chance:
                if name in had or line_kept.get(name) != doc:
                    cut |= set(inside)
                had.add(name)
            at += len(line) + 1
        out.append((doc, frozenset((mine[k][1], mine[k][2]) for k in cut)))
    return dict(out)


def test_the_rule_of_the_query(documents, prose):
    lines = [prose(k, 3 + 4 * (k % 8)) for k in range(14)]
    rows = [(d, "\n".join([prose(90 + d, 12), *lines[d % 5 :], *lines[: d % 7]])) for d in range(6)]
    rows += [(9, lines[3] + " and. " + lines[5] + " " + lines[6]), (10, f"own words. {lines[1]} more own words")]
    rows += [(11, "A b. C d.\nNew line\nA b. C d."), (12, "A b. C d. E f.\nA b. C d.\n\n\nNew line")]
    df = documents(rows)
    found: dict = {doc: [] for doc, _ in rows}
    for x in s.find_repeats(df, "doc_id", "text").collect():
        found[x["doc_id"]].append((x["start"], x["end"]))
    want = by_the_rule(rows, s.CHANCE_WORDS)
    for doc, text in rows:
        inside = {(u[1], u[2]) for u in s.units(text) if any(a <= u[1] and u[2] <= b for a, b in found[doc])}
        assert inside == want[doc], doc


def test_removal_survives_any_column_name(documents):
    df = documents([(1, "One two three.\nx"), (2, "One two three.\ny")]).selectExpr(
        "*", "1 as __spans", "2 as __id", "3 as __key", "4 as spans", "5 as text_key"
    )
    got = s.remove(df, "doc_id", "text", s.find_repeats(df, "doc_id", "text"))
    assert got.columns == df.columns
    assert sorted(r.text for r in got.collect()) == ["One two three.\nx", "y"]
