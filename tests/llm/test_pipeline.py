import random

import corpus_pipeline
from paperloom.llm import queries, simhash
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_mixing import brute as brute_mix
from tests.llm.test_packing import _check
from tests.llm.test_quality import brute as brute_quality
from tests.llm.test_simhash import _groups
from tests.llm.test_simhash import brute as brute_near
from tests.llm.util import CLASH, CLASHING, DOCS, ODD, docs


def _corpus():
    r = random.Random(11)
    vocabulary = ["".join(r.choices("abcdefghilmnorstu", k=r.randint(3, 8))) for _ in range(3000)]
    table = []
    for i in range(260):
        lines = [" ".join(r.choices(vocabulary, k=r.randint(4, 14))) for _ in range(r.randint(2, 8))]
        if i % 9 == 4:
            lines = [line.upper() + " ### %%% &&&" for line in lines]
        if i % 10 == 3:
            lines.insert(1, "a boilerplate line that many of these documents have")
        if i % 13 == 6:
            lines = table[-1][1].split("\n")
        if i % 13 == 9:  # a near copy that shares no line
            lines = [f"{line} z{i}" for line in table[-1][1].split("\n")]
        table.append((i, "\n".join(lines), r.choice(("en", "fr")), r.choice("abc")))
    return table


def _written(spark, tmp_path, frame):
    frame.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_stages_against_brute_force(spark, tmp_path):
    table = _corpus()
    frame = docs(spark, table)
    folder = _written(spark, tmp_path, frame)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup", "mix_sources", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, folder)
        now = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in frame.collect()]
        got = [tuple(r)[:4] for r in out.collect()]
        if name == "quality_rules":
            assert sorted(g[0] for g in got) == sorted(brute_quality(now)) and 0 < len(got) < len(now)
        if name == "line_dedup":
            gone = brute_lines(now)
            want = {i: "\n".join(line for k, line in enumerate(t.split("\n")) if k not in gone[i]) for i, t, *_ in now}
            assert dict(g[:2] for g in got) == {i: t for i, t in want.items() if t}
            assert len(got) < len(now)
        if name == "simhash_near_dedup":
            alive = {t[0] for t in now}
            roots = _groups(brute_near([t for t in table if t[0] in alive]), alive)
            assert sorted(g[0] for g in got) == sorted(set(roots.values())) and len(got) < len(now)
        if name == "mix_sources":
            assert sorted(g[0] for g in got) == sorted(brute_mix(now)) and len(got) > len(now)
        if name == "best_fit_packing":
            _check(out.collect(), [t[:2] for t in now], 2048)
        else:
            assert out.columns == frame.columns
        frame = out


def test_run_on_odd_rows_and_an_empty_table(spark, tmp_path):
    odd = docs(spark, [(*r, *CLASHING) for r in ODD], CLASH)
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.run(spark, _written(spark, tmp_path / "odd", odd)).collect()]
    ids = [i for i, _ in got]
    assert set(ids) == {None, 4, 5, 6}
    assert len({t for i, t in got if i == 5}) == 2 and sum(t.startswith("a null id") for _, t in got) >= 1
    empty = _written(spark, tmp_path / "empty", spark.createDataFrame([], DOCS))
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_near_dedup_sees_what_line_dedup_left(spark, tmp_path):
    """Texts that are alike only without the lines that went, and others that were alike only before; both are found."""
    r = random.Random(5)
    words = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    a, b, core, whole = words(60), words(60), words(40), words(60)
    table = [(0, " ".join(a), "en", "a"), (1, " ".join(b), "en", "a"), (2, " ".join(a) + "\n" + " ".join(core), "en", "a"), (3, " ".join(b) + "\n" + " ".join([*core[1:], "else"]), "en", "a")]
    table += [(4, " ".join(whole[:50]) + "\n" + " ".join(whole[50:]), "en", "a"), (5, " ".join(whole[:50]) + "\n" + " ".join([*whole[51:], "else"]), "en", "a")]
    frame = docs(spark, table)
    folder = _written(spark, tmp_path, frame)
    now = corpus_pipeline.dedup_lines(spark, frame, folder)
    assert {x["doc_id"]: x["text"] for x in now.collect()}[3] == " ".join([*core[1:], "else"])
    classes = {x["id"]: x["keep_id"] for x in simhash.classes(now, before=frame).collect()}
    assert classes == {2: 2, 3: 2, 4: 4, 5: 4}
    assert sorted(x["doc_id"] for x in corpus_pipeline.near_dedup(spark, now, folder).collect()) == [0, 1, 2, 4]


def test_every_operator_has_a_query():
    for n in range(1, 11):
        assert len([q for q in queries.QUERIES if q.startswith(f"op{n}_")]) == 1
    assert set(queries.ORACLES) <= set(queries.QUERIES)
