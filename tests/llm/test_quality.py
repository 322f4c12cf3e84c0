import random
from collections import Counter, defaultdict

from paperloom.llm import quality
from tests.llm.util import DOCS, docs, odd, rows

def _metrics(text):
    words = text.split()
    lines = text.split("\n")
    n = max(len(text), 1)
    bad = sum(not (c.isalpha() or c.isdigit() or c in " \t\n\r") for c in text)
    return {
        "symbols": bad * 1024 // n,
        "uppers": sum(c.isupper() for c in text) * 1024 // n,
        "word_len": sum(c not in " \t\n\r" for c in text) * 16 // max(len(words), 1),
        "uniq": len(set(words)) * 1024 // max(len(words), 1),
        "repeated_lines": 1024 - len(set(lines)) * 1024 // len(lines),
    }


def _bucket(v):
    return v - v % (1 << max(v.bit_length() - 10, 0))


def brute(table):
    groups = defaultdict(lambda: defaultdict(list))
    for _, text, lang, source in table:
        if len(text) >= quality.MIN_CHARS:
            for k, v in _metrics(text).items():
                for at in ((lang, source), (lang,), ()):
                    groups[at][k].append(_bucket(v))

    def sound(text, lang, source, k, v):
        vs = next(sorted(groups[at][k]) for at in ((lang, source), (lang,), ()) if len(groups[at][k]) >= quality.MIN_DOCS or at == ())
        q = lambda share: vs[-(-len(vs) * share // 1000) - 1]
        n = len(text) if k in ("symbols", "uppers") else len(text.split())
        wide = max(1, (1200 if k in ("symbols", "uppers") else 200) / n) ** 0.5
        for times, side in zip(quality.RULES[k], (-1, 1), strict=True):
            spread = next((abs(q(t if side > 0 else 1000 - t) - q(500)) for t in (800, 900, 990, 999) if q(t if side > 0 else 1000 - t) != q(500)), None)
            if times and spread and (v - q(500)) * side > times * spread * wide:
                return False
        return True

    return [i for i, text, lang, source in table if text.split() and all(sound(text, lang, source, k, _bucket(v)) for k, v in _metrics(text).items())]


def _corpus(seed=1, n=420):
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdefghilmnorstu", k=r.randint(2, 9))) for _ in range(900)]
    out = []
    for i in range(n):
        ws = [w.title() if r.random() < 0.1 else w + "," if r.random() < 0.1 else w for w in r.choices(vocabulary, k=r.randint(1, 200))]
        kind = i % 20
        if kind == 3:
            ws = [w + "&&&" for w in ws]
        if kind == 7:
            ws = [w.upper() for w in ws]
        if kind == 11:
            ws = ws[:1] * len(ws)
        text = "".join(w + ("\n" if r.random() < 0.1 else " ") for w in ws)
        out.append((i, text, r.choice(("en", "fr")), r.choice(("big", "big", "big", "small", f"s{i % 5}"))))
    return out


def test_against_brute_force(spark):
    table = _corpus()
    assert sorted(r[0] for r in rows(quality.quality_filter(docs(spark, table)), "doc_id")) == sorted(brute(table))


def test_it_rejects_junk_and_keeps_the_rest(spark):
    table = _corpus(2)
    kept = {r[0] for r in rows(quality.quality_filter(docs(spark, table)), "doc_id")}
    long = [t for t in table if len(t[1].split()) >= 40]
    junk = {t[0] for t in long if t[0] % 20 in (3, 7, 11)}
    assert not junk & kept
    assert {t[0] for t in long} - junk <= kept


def test_texts_of_few_tokens_are_judged(spark):
    table = _corpus(5)
    table += [(9000, "QmFzZTY0" * 5000, "en", "big"), (9001, "#" * 400, "en", "big"), (9002, "a short and sound one", "en", "big")]
    kept = {r[0] for r in rows(quality.quality_filter(docs(spark, table)), "doc_id")}
    assert 9000 not in kept and 9001 not in kept and 9002 in kept and sorted(kept) == sorted(brute(table))


def test_cutoffs_follow_the_group(spark):
    """Shares of symbols that are usual in one source and not in another."""
    r = random.Random(8)
    words = lambda marks: " ".join("".join(r.choices("abcdefghik", k=6)) + ("%" if r.random() < marks else "") for _ in range(150))
    table = [(i, words(0.02 if i % 2 else 0.6), "en", "ab"[i % 2]) for i in range(400)] + [(1000, words(0.6), "en", "b")]
    kept = {x[0] for x in rows(quality.quality_filter(docs(spark, table)), "doc_id")}
    assert 1000 not in kept and len(kept & set(range(400))) >= 396


def test_sketches_merge(spark):
    table = quality.measured(docs(spark, _corpus(3)))
    whole = Counter({tuple(r)[:4]: r["n"] for r in quality.sketches(table).collect()})
    parts = Counter()
    for keep in ("__at % 2 = 0", "__at % 2 = 1"):
        parts += Counter({tuple(r)[:4]: r["n"] for r in quality.sketches(table.where(keep)).collect()})
    assert whole == parts


def test_odd_rows(spark):
    table = odd(spark)
    out = quality.quality_filter(table)
    assert out.columns == table.columns
    texts = [r["text"] for r in out.collect()]
    assert None not in texts and "" not in texts and " \n\t " not in texts
    assert texts.count("the same row twice, and more words in it") == 2


def test_empty_table(spark):
    assert quality.quality_filter(spark.createDataFrame([], DOCS)).count() == 0


def test_join_beyond_the_size_for_broadcast(spark, monkeypatch):
    from paperloom.llm import common

    table = docs(spark, _corpus(4))
    want = rows(quality.quality_filter(table), "doc_id")
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    assert rows(quality.quality_filter(table), "doc_id") == want
