"""Quality rules, line deduplication, mixing."""

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from viewpulse.llm import line_dedup, mixing, quality

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)


def test_lines_against_brute_force(odd, odd_rows):
    first, docs = {}, defaultdict(set)
    order = lambda i: 2**63 if i is None else i
    for i, text, *_ in odd_rows:
        for k in map(key, (text or "").split("\n")):
            if len(k) >= 10:
                first[k] = min(first.get(k, 2**63), order(i))
                docs[k].add(order(i))
    want = Counter()
    for i, text, *_ in odd_rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(docs[key(x)]) < 2 or first[key(x)] == order(i)]
        want[i, "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    got = line_dedup.dedupe_lines(odd)
    assert got.columns == [*odd.columns, "n_lines", "n_dropped"]
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == want


def test_lines_in_more_documents(rows):
    docs = rows("doc_id long, text string", [(i, "three of these") for i in (1, 2, 3)] + [(i, "two of these") for i in (4, 5)])
    got = {r.doc_id: r.n_dropped for r in line_dedup.dedupe_lines(docs, min_docs=3).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0, 5: 0}


def brute_counts(text):
    words = WORDS.findall(text)
    places = defaultdict(list)
    for i in range(len(words) - 2):
        places[tuple(words[i:i + 3])].append(i)
    repeated = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def test_base_counts_against_brute_force(rows, odd_rows):
    texts = [r[1] or "" for r in odd_rows] + ["a b c a b c a", "a a a a", "a a a", "x y z\nx y z\n\n \nü#ö* <b>", "a b c d a b"]
    docs = rows("doc_id long, text string, source string", [(i, t, "s") for i, t in enumerate(texts)])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for r in quality.quality_rules(docs).collect():
        assert tuple(r[n] for n in names) == brute_counts(texts[r.doc_id]), texts[r.doc_id][:80]


def test_quality_keeps_columns_and_rows(odd, odd_rows, none):
    got = quality.quality_rules(odd)
    assert got.columns[:3] == ["doc_id", "text", "lang"] and got.count() == len(odd_rows)
    assert not got.where("text is null and kept").count()
    assert quality.quality_rules(none).count() == 0


def test_boilerplate_of_a_host(rows):
    menu = "\n".join(f"menu{i} entry{i} number{i} of{i} site{i}" for i in range(20))
    own = lambda i: " ".join(f"own{i}w{k}" for k in range(60))
    data = [(i, f"{menu}\n{own(i)}", "site") for i in range(30)] + [(100 + i, f"{menu}\nlittle {i}", "site") for i in range(5)]
    data += [(200, f"{menu}\n{own(200)}", "elsewhere"), (201, menu, "elsewhere"), (202, menu, None)]
    got = {r.doc_id: r for r in quality.quality_rules(rows("doc_id long, text string, source string", data)).collect()}
    assert all(got[i].kept and got[i].text == own(i) and got[i].n_left == 60 for i in range(30))
    assert all(not got[100 + i].kept and not got[100 + i].base_failed for i in range(5))
    assert got[200].kept and got[201].kept and got[202].kept and got[201].text == menu


def brute_taken(sizes, weights=(1, 2, 3), repeats=3):
    """Targets by dealing out again and again."""
    sums = Counter()
    for source, size in sizes:
        sums[source] += size
    names = sorted(sums, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while True:
        left = sum(sums.values()) - sum(target.values())
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > repeats * sums[s]}
        if not over:
            return sums, target | share
        target |= {s: float(repeats * sums[s]) for s in over}
        open_ -= over


def test_mixture(odd, odd_rows):
    items, pieces = mixing.mix(odd, block_words=16)
    pieces = pieces.cache()
    got = mixing.taken(items, pieces).collect()
    assert len(got) == len(odd_rows)
    sums, target = brute_taken([(s, len(WORDS.findall(t or ""))) for _, t, _, s in odd_rows])
    took = Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.source_size == sums[r.source]
        assert abs(r.target - target[r.source]) < 1e-6
        took[r.source] += r.taken
    assert all(abs(took[s] - target[s]) <= 0.5 for s in target)
    assert pieces.groupBy("slot").agg(F.countDistinct("no").alias("n"), F.sum("words").alias("w")).where("n > 1 or w > 16").count() == 0
    again = mixing.taken(*mixing.mix(odd.repartition(2), block_words=16))
    count = lambda rs: Counter((r.id, r.th, r.size, r.taken) for r in rs)
    distinct = {(r.id, r.th) for r in got if sum(x.id == r.id and x.th == r.th for x in got) == 1}
    assert {k for k in count(again.collect()) if k[:2] in distinct} == {k for k in count(got) if k[:2] in distinct}


def test_sources_alternate_in_the_mixture(rows):
    docs = rows("doc_id long, text string, source string", [(i, "w " * 1000, "abc"[i % 3]) for i in range(30)])
    items, pieces = mixing.mix(docs, block_words=50)
    order = [r.no for r in pieces.select("slot", "no").distinct().orderBy("slot").collect()]
    for upto in range(60, len(order), 60):
        share = Counter(order[:upto])
        assert all(abs(share[n] / upto - w) < 0.08 for n, w in ((0, 1 / 6), (1, 1 / 3), (2, 1 / 2)))


def test_mixture_of_nothing(none, rows):
    assert mixing.taken(*mixing.mix(none)).count() == 0
    blank = rows("doc_id long, text string, source string", [(1, None, "a"), (2, " ", None)])
    assert [r.taken for r in mixing.taken(*mixing.mix(blank)).collect()] == [0, 0]
    assert mixing.mixed_documents(blank).count() == 0


def test_mixed_documents_repeat(odd, rows):
    assert mixing.mixed_documents(odd).columns == odd.columns
    docs = rows("doc_id long, text string, source string", [(1, "a b c d", "x"), *((i, "w " * 50, "y") for i in range(2, 12))])
    times = Counter(r.doc_id for r in mixing.mixed_documents(docs).collect())
    assert times[1] == 3
