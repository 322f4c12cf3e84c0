import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from paperloom.llm import line_dedup
from tests.llm.util import DOCS, docs, odd

SMALL = st.lists(st.integers(0, 8), max_size=14)


@settings(max_examples=200, deadline=None)
@given(SMALL, SMALL)
def test_patience_gives_a_common_subsequence(a, b):
    pairs = line_dedup.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    if len(set(a)) == len(a) and a == b:
        assert len(pairs) == len(a)


def brute(table, min_words=line_dedup.MIN_WORDS):
    """Without alignment: the lines of each document in stretches, one line behind the other, of enough words that an earlier document
    has, too. Lines that stand alone in the table aren't counted as between others. For documents whose lines are all different."""
    order = sorted(table, key=lambda t: (t[0] is None, t[0] or 0))
    split = [[(k, line.strip()) for k, line in enumerate((t[1] or "").split("\n")) if line.split()] for t in order]
    gone = {}
    for y, b in enumerate(split):
        lost = set()
        for a in split[:y]:
            at = {line: k for k, line in a}
            run = []
            for k, line in [*b, (-9, "")]:
                if run and line in at and k == run[-1][0] + 1 and at[line] == at[run[-1][1]] + 1:
                    run.append((k, line))
                    continue
                if sum(len(x.split()) for _, x in run) >= min_words:
                    lost |= {x for x, _ in run}
                run = [(k, line)] if line in at else []
        gone[order[y][0]] = lost
    return gone


def _corpus(seed, n=60):
    r = random.Random(seed)
    line = lambda: " ".join(r.choices("alpha beta gamma delta epsilon zeta eta theta iota kappa".split(), k=r.randint(1, 9)))
    passages = [[line() + f" p{k} {j}" for j in range(r.randint(1, 5))] for k in range(8)]
    table = []
    for i in range(n):
        lines = [line() + f" own {i} {j}" for j in range(r.randint(0, 8))]
        for p in r.sample(passages, r.randint(0, 3)):
            at = r.randint(0, len(lines))
            lines[at:at] = p
        if r.random() < 0.1 and table:
            lines = table[r.randrange(len(table))][1].split("\n")
        table.append((i, "\n".join(lines), "en", "a"))
    return table


def test_against_brute_force(spark):
    for seed in (1, 2):
        table = [t for t in _corpus(seed) if t[1]]
        want = brute(table)
        got = {r["id"]: set(r["gone"]) for r in line_dedup.deletions(docs(spark, table)).collect()}
        assert sum(map(len, want.values())) > 50 and got == {i: w for i, w in want.items() if w}


@settings(max_examples=300, deadline=None)
@given(SMALL, SMALL)
def test_no_stretch_of_a_pair_is_left(a, b):
    """Lines that stand several times in both: what is left of the later holds no stretch that is left of the earlier as often."""
    early, late = list(enumerate(a)), [(k, h, 2) for k, h in enumerate(b)]
    gone = set(line_dedup.aligned_blocks(early, late, 4))
    twos = lambda s: Counter(zip(s, s[1:], strict=False))
    assert all(not (k in gone) or any((k + d) in gone for d in (-1, 1)) for k in gone)
    if not gone:
        assert not twos(a) & twos(b)


def test_frequent_lines_are_deleted_from_all_but_the_first(spark):
    table = [(i, f"own line of the document number {i}\nshared line that very many documents have\nlast line {i} of it all", "en", "a") for i in range(400)]
    out = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(docs(spark, table)).collect()}
    assert "shared line" in out[0] and not any("shared line" in out[i] for i in range(1, 400))
    assert all(f"number {i}\nlast line {i} of" in out[i] for i in range(1, 400))


def test_a_long_repeated_passage_goes_and_short_chance_lines_stay(spark):
    passage = "\n".join(f"sentence {k} of a passage with some more words" for k in range(8))
    table = [(1, f"head one\n{passage}\nyes\nfoot one", "en", "a"), (2, f"head two\nyes\nno\n{passage}\nfoot two", "en", "b"), (3, "yes\nno\nsomething else", "en", "b")]
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in line_dedup.line_dedup(docs(spark, table)).collect()}
    assert out[1][0] == table[0][1] and out[3][0] == table[2][1]
    assert out[2] == ("head two\nyes\nno\nfoot two", len("head two\nyes\nno\nfoot two"))


def test_copies_are_left_out_or_empty(spark):
    text = "a first line of several words\nanother line of several words"
    table = docs(spark, [(1, text, "en", "a"), (2, text, "en", "a")])
    assert [r["doc_id"] for r in line_dedup.line_dedup(table).collect()] == [1]
    assert sorted((r["doc_id"], r["text"]) for r in line_dedup.line_dedup(table, drop_emptied=False).collect()) == [(1, text), (2, "")]


def test_odd_rows_and_empty_table(spark):
    table = odd(spark)
    out = line_dedup.line_dedup(table)
    assert out.columns == table.columns
    want = list(map(str, table.collect()))
    want.remove(next(r for r in want if "the same row twice" in r))
    assert sorted(map(str, out.collect())) == sorted(want)
    assert line_dedup.line_dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_one_of_repeated_rows_and_of_copies_without_ids_stays(spark):
    text = "a first line of several words\nanother line of several words"
    table = [(None, text, "en", "a"), (None, text, "en", "a"), (7, "words of another text that stands here twice", "en", "a"), (7, "words of another text that stands here twice", "en", "a"), (None, None, "en", "a"), (None, None, "en", "a")]
    out = line_dedup.line_dedup(docs(spark, table)).collect()
    assert sorted(str((r["doc_id"], r["text"])) for r in out) == sorted(str(table[i][:2]) for i in (0, 2, 4, 5))


def whole(table, min_words=line_dedup.MIN_WORDS):
    """Every document against every earlier one on the lines of two documents or more, without any condition."""
    split = [[(k, line.strip()) for k, line in enumerate(t[1].split("\n")) if line.split()] for t in table]
    documents = Counter(line for lines in split for line in {line for _, line in lines})
    split = [[(k, line) for k, line in lines if documents[line] > 1] for lines in split]
    return {t[0]: {k for x in range(y) for k in line_dedup.aligned_blocks([(k, hash(line)) for k, line in split[x]], [(k, hash(line), len(line.split())) for k, line in split[y]], min_words)} for y, t in enumerate(table)}


def test_what_later_documents_share_beside_a_frequent_line(spark):
    """Short lines beside a line of 40 documents, and a second occurrence of it, that the first of them doesn't have."""
    hot = "a line that very many documents have"
    table = [(i, f"{hot}\nown {i}", "en", "a") for i in range(40)]
    table += [(40, f"own 40\nshort\n{hot}\nafter it\nthe end\nown 40 b\n{hot}", "en", "a"), (41, f"own 41\nshort\n{hot}\nafter it\nthe end\nown 41 b\n{hot}", "en", "a"), (42, f"own 42\n{hot}\nown 42 b\n{hot}", "en", "a")]
    want = whole(table)
    got = {r["id"]: set(r["gone"]) for r in line_dedup.deletions(docs(spark, table)).collect()}
    assert want[41] == {1, 2, 3, 4, 6} and got == {i: w for i, w in want.items() if w}


def test_passages_of_short_lines_and_of_scripts_without_blanks(spark):
    verse = "roses are red\nviolets are blue\nand so on"
    chinese = "这是一行没有空格的文字"
    table = [(1, f"head one\n{verse}\nfoot one", "en", "a"), (2, f"head two\n{verse}\nfoot two", "en", "a"), (3, f"第一\n{chinese}", "zh", "a"), (4, f"第二\n{chinese}\n结束", "zh", "a")]
    out = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(docs(spark, table)).collect()}
    assert out == {1: table[0][1], 2: "head two\nfoot two", 3: table[2][1], 4: "第二\n结束"}
    for seed in (3, 4):
        table = [(i, "\n".join(" ".join(line.split()[-3:]) for line in t.split("\n")), lang, s) for i, t, lang, s in _corpus(seed) if t]
        want = brute(table)
        got = {r["id"]: set(r["gone"]) for r in line_dedup.deletions(docs(spark, table)).collect()}
        assert sum(map(len, want.values())) > 50 and got == {i: w for i, w in want.items() if w}
