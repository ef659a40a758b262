from collections import Counter

from panelwise.llm import line_frequency as lf

from .conftest import make_docs, some_texts


def figures(text):
    t = text or ""
    ws = t.encode().split()
    lines = [x for x in t.split("\n") if x.encode().split()]
    windows = [tuple(ws[i:i + 8]) for i in range(len(ws) - 7)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(8)}
    return (len(ws), sum(len(w.decode()) for w in ws), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_figures(spark):
    texts = some_texts() + ["a|b #x\n" * 3 + " \n\t\nq", "one two three four five six seven eight " * 2, "x\x0by\x0cz\rq"]
    got = {r["doc_id"]: r for r in lf.line_rules(make_docs(spark, texts), ["doc_id"]).collect()}
    for i, t in enumerate(texts):
        r, f = got[i], figures(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == f, t
        assert r["base_failed"] == (f[0] < 20 or 100 * f[4] > 30 * f[0])


def test_common_lines_go(spark):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    notice = "All  Rights RESERVED by the site owner and its many partners"
    texts = [f"{own(i)}\n{notice if i % 2 else notice.lower()} " for i in range(12)]       # line in 12 documents of h
    texts += [f"{own(50)}\n" + "\n".join(f"{notice} " for _ in range(7))]                   # depleted: 70 of 100 words go
    texts += [f"{own(60 + i)}\nonly here {i // 3}" for i in range(9)]
    sources = ["h"] * 13 + ["other"] * 9
    docs = make_docs(spark, texts + [f"{own(90)}\n{notice}"], sources=sources + [None])
    got = {r["doc_id"]: r for r in lf.line_rules(docs, ["doc_id"]).collect()}
    assert [got[i]["n_removed_words"] for i in range(12)] == [11] * 12 and all(got[i]["kept"] for i in range(12))
    assert got[12]["n_removed_words"] == 77 and not got[12]["kept"]
    assert all(got[i]["n_removed_words"] == 0 and got[i]["kept"] for i in range(13, 23))


def test_cleaned_text(spark):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    notice = "All  Rights RESERVED by the site owner"
    texts = [f"{own(i)}\n\n{notice if i % 2 else notice.lower()} \n tail  {i}\n" for i in range(12)] + [notice, None, ""]
    docs = make_docs(spark, texts + [f"x\n{notice}"], sources=["h"] * 15 + [None])
    got = {r["doc_id"]: r for r in lf.line_rules(docs, ["doc_id", "text"]).collect()}
    assert [got[i]["cleaned_text"] for i in range(12)] == [f"{own(i)}\n\n tail  {i}\n" for i in range(12)]
    assert [got[i]["cleaned_text"] for i in range(12, 16)] == ["", None, "", f"x\n{notice}"]
    for r in got.values():
        assert r["n_words"] - r["n_removed_words"] == figures(r["cleaned_text"])[0]


def test_limit_does_not_move_with_the_host(spark):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    texts = [f"{own(i)}\nshared notice line" if i < 15 else own(i) for i in range(2000)]  # 1% of the host is 20
    got = {r["doc_id"]: r for r in lf.line_rules(make_docs(spark, texts, sources=["h"]), ["doc_id"]).collect()}
    assert all(got[i]["n_removed_words"] == 3 and got[i]["cleaned_text"] == own(i) for i in range(15))
    assert all(got[i]["n_removed_words"] == 0 for i in range(15, 2000))


def test_copies_clashing_names_and_long_texts(spark):
    import hashlib
    line = " ".join(f"v{k}" for k in range(25))
    long = "\n".join(f"{line} {i}" for i in range(8000))
    docs = make_docs(spark, [f"{line}\n{line}\nend"] * 40 + [long, None], sources=["h"] * 40 + ["g", "g"], ids=[1] * 30 + list(range(2, 14)))
    out = lf.line_rules(docs.selectExpr("*", "1 as host", "2 as kept", "3 as n_words", "4 as lines", "5 as c0"),
                        ["doc_id", "host", "kept", "n_words", "lines", "c0", "text"])
    assert out.columns[:7] == ["doc_id", "host", "given_kept", "given_n_words", "lines", "c0", "text"]
    rows = out.collect()
    assert len(rows) == 42 and all((r["host"], r["given_kept"], r["given_n_words"], r["lines"], r["c0"]) == (1, 2, 3, 4, 5) for r in rows)
    copies = [r for r in rows if r["text"] and r["text"].startswith(line + "\n" + line)]
    assert len(copies) == 40 and all(r["n_removed_words"] == 51 and r["cleaned_text"] == "" for r in copies)
    other = [r for r in rows if r["text"] == long][0]
    assert other["n_words"] == 8000 * 26 and other["n_removed_words"] == 0 and other["cleaned_text"] == long
    assert all(r["cleaned_sha256"] == hashlib.sha256((r["cleaned_text"] or "").encode()).hexdigest() for r in rows)


def test_empty(no_docs, docs):
    assert lf.line_rules(no_docs, ["doc_id"]).count() == 0
    out = lf.line_rules(docs, docs.columns[:5])
    assert out.count() == docs.count() and out.where("kept is null").count() == 0
