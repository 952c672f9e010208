from __future__ import annotations

from siftledger.llm import templates

ITEM = "What is the total cost when Anna buys 12 apples at 3 dollars each and sells them to Peter for 5 dollars each?"
OTHER = "what is the total cost when Maria buys 40 apples at 7 euros each and sells them to Hans for 9 euros each?"
MIXED = "what is the total cost when Maria buys 40 apples at 7 euros each and sells them to Maria for 9 euros each?"
PLAIN = "The river ran past the old mill and turned its wheel for a hundred quiet summers before the flood."


def bench(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def found(docs, benchmark, **options):
    rows = templates.with_leaks(docs, benchmark, **options).collect()
    return {r["doc_id"]: [(x["item_id"], x["changed"] > 0) for x in r["leaks"]] for r in rows}


def test_verbatim_reworded_and_inconsistent(spark, documents):
    docs = documents(
        (1, f"Lead in. {ITEM} And on."),
        (2, f"Lead in. {OTHER} And on."),
        (3, f"Lead in. {MIXED} And on."),
        (4, f"some lead {PLAIN.lower()} some end"),
        (5, "Nothing that the benchmark has, only plain words about the weather and the sea."),
        (6, " ".join(PLAIN.split()[:12])),
    )
    leaks = found(docs, bench(spark, (10, ITEM), (20, PLAIN)))
    assert leaks == {1: [(10, False)], 2: [(10, True)], 3: [], 4: [(20, False)], 5: [], 6: []}


def test_blocks_give_the_same(spark, documents):
    docs = documents((1, f"x {ITEM} y {PLAIN} z"), (2, PLAIN), (3, None))
    benchmark = bench(spark, (10, ITEM), (20, PLAIN), (30, None), (40, ""))
    whole = found(docs, benchmark)
    assert whole == {1: [(10, False), (20, False)], 2: [(20, False)], 3: []}
    assert found(docs, benchmark, block_words=5) == whole


def test_short_item_is_one_window(spark, documents):
    docs = documents((1, "he said to be or not to be, and left"), (2, "he said to be or not, and left"))
    assert found(docs, bench(spark, (1, "To be or not to be"))) == {1: [(1, False)], 2: []}


def test_awkward_rows_pass_through(spark, awkward):
    docs = awkward.withColumnRenamed("source", "leaks")
    kept = templates.decontaminated(docs, bench(spark, (1, PLAIN), (1, ITEM)))
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    assert templates.decontaminated(docs, bench(spark)).count() == docs.count()
    assert templates.decontaminated(docs.limit(0), bench(spark, (1, PLAIN))).count() == 0


def test_against_brute_force(spark, documents):
    """Verbatim passages at any place, against a search for 13 equal words in a row."""
    import random

    draw = random.Random(3)
    vocabulary = [f"w{i}x" for i in range(60)]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(13, 30)))) for i in range(20)]
    rows = []
    for i in range(120):
        words = draw.choices(vocabulary, k=80)
        if i % 3 == 0:
            item = items[i % 20][1].split()
            at = draw.randint(0, 79)
            words[at:at] = item[: draw.randint(8, len(item))]
        rows.append((i, " ".join(words)))
    runs = {}
    for item, text in items:
        w = text.split()
        for k in range(len(w) - 12):
            runs.setdefault(tuple(w[k : k + 13]), set()).add(item)
    expected = set()
    for doc, text in rows:
        w = text.split()
        for k in range(len(w) - 12):
            expected |= {(doc, item) for item in runs.get(tuple(w[k : k + 13]), ())}
    got = templates.leaked_items(documents(*rows), bench(spark, *items)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == expected


def test_repeated_and_null_ids(spark, documents):
    docs = documents((1, f"x {ITEM} y"), (2, f"x {PLAIN} y"), (3, f"x {PLAIN} y {ITEM} z"), (4, OTHER))
    rows = [(1, ITEM), (1, PLAIN), (None, ITEM), (None, PLAIN), (None, "To be or not to be")]
    both = [(None, False), (1, False)]
    expected = {1: both, 2: both, 3: both, 4: [(None, True), (1, True)]}
    for words in (1_000_000, 5):
        assert found(docs, bench(spark, *rows), block_words=words) == expected


def test_an_inconsistent_slot_takes_only_its_windows(spark, documents):
    long = "Then Anna went. " + " ".join(f"plain{'abcdefghij'[i % 10]}{'klmnop'[i // 10]}" for i in range(40))
    long += " and so the good Anna met all of her old friends"
    half = long.replace("good Anna", "good Maria")
    threes = "in the shop 3 pens are on the table and each of them costs a buyer just 3 dollars in all"
    docs = documents(
        (1, half),
        (2, threes.replace("shop 3", "shop 7").replace("just 3", "just 4")),
        (3, ITEM.replace("12 apples at 3", "5 apples at 5")),
        (4, MIXED),
    )
    leaks = found(docs, bench(spark, (1, long), (2, threes), (3, ITEM)))
    assert {k: [x for x, _ in v] for k, v in leaks.items()} == {1: [1], 2: [2], 3: [3], 4: []}
    (row,) = templates.with_leaks(docs.where("doc_id = 1"), bench(spark, (1, long))).collect()
    assert row["leaks"][0]["words"] >= 40


def test_which_slots_are_inconsistent():
    """Kinds: 1 is a number, 3 a name."""
    assert templates._inconsistent([(0, 3, "a", "m"), (5, 3, "p", "m")]) == {0, 5}
    assert templates._inconsistent([(0, 3, "a", "m"), (5, 3, "a", "m"), (9, 3, "a", "h")]) == {9}
    assert templates._inconsistent([(0, 1, "3", "7"), (5, 1, "3", "4"), (9, 1, "12", "4")]) == set()
