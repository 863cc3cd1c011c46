import random

from corpusforge.llm import sentencespans as ss
from tests.llm.helpers import docs_of

PASSAGE = ("The quick harbour master counted nine blue barrels before noon. Nobody else had seen the heavy ropes that evening. "
           "A small crowd waited near the old gate for the ferry. They talked about salt, wind and the price of bread. "
           "Later the bell rang twice and everyone walked slowly home again.")


def _prose(rng, n):
    return " ".join(" ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(3, 14))) + "."
                    for _ in range(n))


def _brute(rows):
    """Cut texts by a plain reading of the rule, in (id, hash order of text) order of distinct rows."""
    places, seen = {}, {}
    for i, t in sorted(set(r for r in rows if r[1] is not None)):
        _, keys, counts = ss.sentences(t)
        for a in range(len(keys)):
            for b in range(a + ss.SPAN - 1, len(keys)):
                words = sum(counts[a:b + 1])
                shortest_from = b == a + ss.SPAN - 1 or sum(counts[a:b]) < ss.MIN_WORDS
                shortest_to = b == a + ss.SPAN - 1 or sum(counts[a + 1:b + 1]) < ss.MIN_WORDS
                if words >= ss.MIN_WORDS and (shortest_from or shortest_to):
                    places.setdefault(b"\n".join(keys[a:b + 1]), []).append((i, a, b))
        seen[i] = len(keys)
    gone = {i: set() for i in seen}
    for at in places.values():
        for i, a, b in sorted(at)[1:]:
            gone[i].update(range(a, b + 1))
    return {i: len(g) for i, g in gone.items()}


def _rows():
    rng = random.Random(5)
    rows = [(i, _prose(rng, rng.randint(1, 12))) for i in range(30)]
    for i in range(30, 40):                                     # a passage amid own prose, on its own line or in the flow
        rows.append((i, _prose(rng, 3) + ("\n" if i % 2 else " ") + PASSAGE + " " + _prose(rng, 2)))
    rows += [(40, rows[3][1]), (41, "Yes. No. Ok."), (42, "Yes. No. Ok."), (43, None), (44, ""), (45, _prose(rng, 4) * 2)]
    return rows


def test_against_brute_force(spark):
    rows = _rows()
    got = {r["doc_id"]: r for r in ss.dedup_spans(docs_of(spark, [(*r, "k") for r in rows], ", n_removed string")).collect()}
    assert len(got) == len(rows)
    want = _brute(rows)
    assert {i: r["n_removed"] for i, r in got.items() if i in want} == want
    texts = dict(rows)
    assert all(got[i]["text"] == texts[i] for i in got if got[i]["n_removed"] == 0)
    assert sum(PASSAGE in (r["text"] or "") for r in got.values()) == 1 and PASSAGE in got[30]["text"]
    assert not any("harbour" in got[i]["text"] or "bell rang" in got[i]["text"] for i in range(31, 40))
    assert got[40]["text"] == "" and got[42]["text"] == "Yes. No. Ok." and got[43]["text"] is None


def test_passage_of_one_long_sentence(spark):
    rng = random.Random(8)
    long = " ".join("".join(rng.choice("qrstuvwxyz") for _ in range(5)) for _ in range(53)) + "."
    rows = [(i, _prose(rng, 3) + "\n" + long + "\n" + _prose(rng, 3)) for i in range(4)]
    got = {r["doc_id"]: r["text"] for r in ss.dedup_spans(docs_of(spark, rows)).collect()}
    assert long in got[0] and not any(long[:60] in got[i] or long[-60:] in got[i] for i in (1, 2, 3))


def test_repeated_rows_nulls_and_empty(spark):
    rng = random.Random(9)
    t = _prose(rng, 8)
    got = ss.dedup_spans(docs_of(spark, [(1, t), (1, t), (None, t), (None, None)])).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in got if r["text"] is not None) == [("1", ""), ("1", ""), ("None", t)]
    assert ss.dedup_spans(docs_of(spark, [])).count() == 0


def _words(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def test_passage_at_every_offset_of_long_sentences(spark):
    rng = random.Random(31)
    rows = []
    for stops in (False, True):                                  # unpunctuated; a full stop every 30 words
        passage = [w + "." if stops and i in (20, 50) else w for i, w in enumerate(_words(rng, 51))]
        for offset in range(40):
            before, after = _words(rng, offset), _words(rng, 30)
            rows.append((len(rows), " ".join(before + passage + after)))
    got = {r["doc_id"]: r for r in ss.dedup_spans(docs_of(spark, rows)).collect()}
    for i, t in rows:
        lost = len(t.split()) - len(got[i]["text"].split())
        assert lost == 0 if i % 40 == 0 else 20 <= lost <= 51, (i, lost)
        offset = i % 40                                          # nothing but repeated words goes
        assert got[i]["text"].split()[:offset] == t.split()[:offset] and got[i]["text"].split()[-30:] == t.split()[-30:]


def test_scripts_without_spaces(spark):
    rng = random.Random(33)
    some = lambda lo, n: "".join(chr(lo + rng.randrange(40)) for _ in range(n))
    texts, planted = [], []
    for lo, stop in ((0x4e00, ""), (0x4e00, "。"), (0x3042, "！"), (0x0e01, "")):
        passage = stop.join(some(lo, 25) for _ in range(6)) + stop
        for offset in (0, 1, 5, 16, 23, 40):
            before, after = some(lo + 8, offset), some(lo + 8, 60)
            texts.append(before + passage + after), planted.append((len(passage), offset))
    texts += [some(0x4e00, 40) + "。"] * 2 + ["「" + some(0x4e00, 9) + "。」" + some(0x4e00, 9) + "。短い。"] * 2
    got = {r["doc_id"]: r for r in ss.dedup_spans(docs_of(spark, list(enumerate(texts)))).collect()}
    for i, (size, offset) in enumerate(planted):
        lost = len(texts[i]) - len(got[i]["text"])
        assert lost == 0 if i % 6 == 0 else size - 32 <= lost <= size, (i, lost)
        assert got[i]["text"][:offset] == texts[i][:offset] and got[i]["text"][-60:] == texts[i][-60:]
    n = len(planted)
    assert [got[n + i]["text"] for i in range(4)] == [texts[n], "", texts[n + 2], ""]
    assert got[n + 2]["n_sentences"] == 3


def test_breaks_and_pieces_give_the_text_back():
    for text in ("One. Two!  Three…\nfour", "第一。」第二！？ 第三。\n\n第四", "\u3000第一\u3000二三 x\u3000" * 9, " a日本b ไทย c. " * 9, "", "\n。"):
        ends, keys, counts = ss.sentences(text)
        assert len(ends) == len(keys) == len(counts) and ends == sorted(set(ends))
        assert not text.strip() or not text[ends[-1]:].strip()


def _slow_sentences(text):
    """Sentences by the full pattern and the search for every word (the rule as first written)."""
    ends, keys, counts, begin = [], [], [], 0
    word = ss._WORD if ss._SPACELESS.search(text) else ss._PLAIN_WORD
    for stop in [m.end() for m in ss._BREAK.finditer(text)] + [len(text)]:
        own = text[begin:stop].lstrip()
        found = list(word.finditer(own))
        if not found:
            continue
        words = " ".join(m[0].rstrip() for m in found).lower().encode().split(b" ")
        cuts = ss._cuts(words) if len(words) > ss.MAX_WORDS else []
        ends += [stop - len(own) + found[c - 1].end() for c in cuts] + [stop]
        for i, j in zip([0, *cuts], [*cuts, len(words)]):
            keys.append(b" ".join(words[i:j])), counts.append(j - i)
        begin = stop
    return ends, keys, counts


def test_quick_breaks_and_word_ends_are_those_of_the_rule():
    rng = random.Random(12)
    signs = ["a", "bc", "D", "İ", ".", "!", "…", " ", " ", "\n", "\t", "\u00a0", "。", "」", "！", "日", "ไ", "x.y", "\r"]
    for _ in range(3000):
        some = rng.sample(signs, rng.randint(3, len(signs)))
        text = "".join(rng.choice(some) for _ in range(rng.choice((6, 24, 90))))
        assert ss.sentences(text) == _slow_sentences(text), text
    for gap in ([" "], [" ", "  ", "\t"]):
        text = "  " + "".join("".join(rng.choice("abİ") for _ in range(3)) + rng.choice(gap) for _ in range(80)) + "\n"
        assert ss.sentences(text) == _slow_sentences(text)


def test_runs_equal_in_half_a_hash_stay_apart(spark):
    places = spark.createDataFrame([(1, 7, 1, 5, 0, 2), (1, 8, 2, 5, 0, 2), (1, 8, 3, 5, 4, 6), (2, 1, 4, 5, 0, 2), (2, 1, 4, 5, 0, 2)],
                                   "h long, g long, doc_id long, th long, a int, b int")
    got = [(r["doc_id"], [tuple(x) for x in r["runs"]]) for r in ss.repeated_places(places).collect()]
    assert got == [(3, [(4, 6)])]
