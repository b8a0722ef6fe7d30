"""Document fingerprints: a Merkle tree over paragraphs and sections, in built-in functions only.

A paragraph is a piece of text up to and with a line end or a sentence end
(``.``, ``!`` or ``?`` and the blank after it, or a full-width one).  One longer
than ``LONG`` is cut further after words, or after characters of a run without
blanks, that a hash of the word and the one before picks; what is then still
longer than ``LONGEST`` is cut at that length.  So no leaf is longer, texts
without sentences have leaves too, and an edit changes the leaves near it only.
Joined, the paragraphs are the text.  A section is a run of paragraphs up to one whose hash has three low zero
bits, so sections depend on what they hold and an edit moves no boundary
elsewhere.  A section's hash is the SHA-256 of its paragraphs' hashes, the
root's that of its sections': equal roots mean equal texts, and branches that
differ lead to the paragraphs that differ.

For comparison each paragraph also has a code, 44 bits of a hash with its
length below them, so that sets of paragraphs are intersected as arrays of
longs and the length of what they share is read off the codes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from drayline.session import RunFolder

PARAGRAPH_END = r"(?<=\n)|(?<=[.!?] )|(?<=[。！？｡])"
#: Characters of a paragraph, and of a run without blanks, that stay in one piece.
LONG, LONG_RUN = 128, 64
#: One word in so many more than this ends a piece of a long paragraph.
PIECE_BITS = 7
#: Characters of the longest leaf.
LONGEST = 512
SECTION_BITS = 7
LENGTH_BITS = 20
LENGTH_MASK = (1 << LENGTH_BITS) - 1
#: Text of one stretch of the id order.
STRETCH_BYTES = 16 << 20


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, also inside a lambda."""
    return F.get(F.transform(F.array(value), use), 0)


def _pieces(paragraph: Column) -> Column:
    """The content-defined pieces of a long paragraph."""
    words = F.flatten(F.transform(F.split(paragraph, r"(?<=\s)"), lambda w: F.when(F.length(w) > LONG_RUN, F.split(w, "")).otherwise(F.array(w))))

    def cut(words: Column) -> Column:
        ends = F.filter(
            F.sequence(F.lit(0), F.size(words) - 1),
            lambda i: (F.xxhash64(F.get(words, i - 1), F.get(words, i)).bitwiseAND(PIECE_BITS) == 0) | (i == F.size(words) - 1),
        )

        def piece(ends: Column) -> Column:
            def joined(end: Column, k: Column) -> Column:
                begin = F.when(k == 0, 0).otherwise(F.get(ends, k - 1) + 1)
                return F.array_join(F.slice(words, begin + 1, end - begin + 1), "")

            return F.transform(ends, joined)

        return _with(ends, piece)

    bounded = F.transform(
        _with(words, cut),
        lambda x: F.when(F.length(x) > LONGEST, F.regexp_extract_all(x, F.lit(f"(?s).{{1,{LONGEST}}}"), F.lit(0))).otherwise(F.array(x)),
    )
    return F.filter(F.flatten(bounded), lambda x: F.length(x) > 0)


def _paragraphs(text: Column) -> Column:
    cut = F.transform(F.split(text, PARAGRAPH_END), lambda x: F.when(F.length(x) > LONG, _pieces(x)).otherwise(F.array(x)))
    return F.when(F.length(text) > 0, F.flatten(cut)).otherwise(F.array().cast("array<string>"))


def _code(paragraph: Column) -> Column:
    size = F.least(F.length(paragraph), F.lit(LENGTH_MASK)).cast("long")
    return F.shiftleft(F.xxhash64(paragraph), LENGTH_BITS).bitwiseOR(size)


def with_tree(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """Add ``<prefix>codes`` and ``<prefix>hashes`` of the paragraphs, ``<prefix>sections`` and ``<prefix>root`` of a text column.

    ``<prefix>sections`` holds each section's hash and its last paragraph.
    Every array is used twice where it is used, so the optimiser computes it
    once a row and not again for each element.
    """
    p = lambda name: f"{prefix}{name}"
    df = df.withColumn(p("paragraphs"), _paragraphs(F.col(text)))
    df = df.withColumns(
        {
            p("codes"): F.transform(p("paragraphs"), _code),
            p("hashes"): F.transform(p("paragraphs"), lambda x: F.sha2(x, 256)),
            p("count"): F.size(p("paragraphs")),
        }
    ).drop(p("paragraphs"))
    last = F.transform(
        p("codes"),
        lambda c, i: F.when((F.shiftright(c, LENGTH_BITS).bitwiseAND(SECTION_BITS) == 0) | (i == F.col(p("count")) - 1), i),
    )
    df = df.withColumn(p("ends"), F.filter(last, lambda i: i.isNotNull()))

    def section(end: Column, k: Column) -> Column:
        begin = F.when(k == 0, 0).otherwise(F.get(F.col(p("ends")), k - 1) + 1)
        joined = F.array_join(F.slice(p("hashes"), begin + 1, end - begin + 1), "")
        return F.struct(F.sha2(joined, 256).alias("hash"), end.alias("last"))

    df = df.withColumns({p("sections"): F.transform(p("ends"), section), p("n_paragraphs"): F.size(p("hashes"))})
    root = F.sha2(F.array_join(F.transform(p("sections"), lambda s: s["hash"]), ""), 256)
    return df.withColumn(p("root"), root).drop(p("ends"), p("count"), p("n_paragraphs"))


def _weight(codes: Column) -> Column:
    return F.aggregate(codes, F.lit(0).cast("long"), lambda a, c: a + c.bitwiseAND(F.lit(LENGTH_MASK).cast("long")))


def likeness(first: Column, second: Column) -> Column:
    """Twice the length of the paragraphs that two texts share over the length of the paragraphs of both, each counted once.

    One for equal texts, two empty ones included; zero if nothing is shared.
    """
    both = _weight(F.array_distinct(first)) + _weight(F.array_distinct(second))
    return F.when(both > 0, 2.0 * _weight(F.array_intersect(first, second)) / both).otherwise(F.lit(1.0))


def changed_paragraphs(first: str, second: str) -> Column:
    """Places (from 0) of the paragraphs of the tree ``first`` that the tree ``second`` lacks.

    Only sections whose hash the other tree does not have are opened.
    """
    known = F.transform(f"{second}sections", lambda s: s["hash"])

    def places(section: Column, k: Column) -> Column:
        begin = F.when(k == 0, 0).otherwise(F.get(F.col(f"{first}sections"), k - 1)["last"] + 1)
        inside = F.filter(
            F.sequence(begin, section["last"]),
            lambda i: ~F.array_contains(F.col(f"{second}hashes"), F.get(F.col(f"{first}hashes"), i)),
        )
        return F.when(F.array_contains(known, section["hash"]), F.array().cast("array<int>")).otherwise(inside)

    return F.flatten(F.transform(f"{first}sections", places))


def _stretch(value: Column, bounds: list[int]) -> Column:
    """How many bounds are at most the value, by bisection; zero for null."""
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    if not bounds:
        return F.lit(0)
    held = F.array(*[F.lit(b).cast("long") for b in bounds])
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(F.get(held, at + step - 1) <= value, at + step).otherwise(at),
    )


def with_next(df: DataFrame, id_col: str, size: Column, columns: list[str], order: list[Column]) -> DataFrame:
    """Add ``next_<column>``: the value in the row that follows in descending order of an integer id, cyclically.

    The order is cut into stretches at quantiles of the id, about
    ``STRETCH_BYTES`` each by ``size``; inside a stretch a window looks ahead,
    and the last row of each takes the first row of the stretch after it.  Null
    ids come last.  ``order`` breaks ties.
    """
    stats = df.agg(F.sum(size), F.count("*")).first()
    stretches = max(1, -(-int(stats[0] or 0) // STRETCH_BYTES))
    bounds: list[int] = []
    if stretches > 1:
        shares = [k / stretches for k in range(1, stretches)]
        found = df.agg(F.percentile_approx(F.col(id_col), shares, max(10_000, 20 * stretches))).first()[0] or []
        bounds = sorted(set(found))
    df = df.withColumn("stretch", _stretch(F.col(id_col), bounds))
    ranked = [F.col(id_col).desc_nulls_last(), *order]
    inside = Window.partitionBy("stretch").orderBy(*ranked)
    ahead = df.withColumns({f"next_{c}": F.lead(c).over(inside) for c in columns} | {"closing": F.lead(F.lit(True)).over(inside).isNull()})
    # one row a stretch: its first row's values; the smallest of a sort key is an aggregate that tasks form for their own rows
    key = F.struct((-F.col(id_col)).alias("i"), *[c.alias(f"k{j}") for j, c in enumerate(order)])
    filled = F.when(F.col(id_col).isNull(), F.lit(1)).otherwise(0)
    first = df.groupBy("stretch").agg(F.min_by(F.struct(*columns), F.struct(filled.alias("n"), key.alias("k"))).alias("first"))
    following = Window.orderBy(F.col("stretch").desc())
    everything = following.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    number = first.select("stretch")
    after = number.select("stretch", F.coalesce(F.lead("stretch").over(following), F.first("stretch").over(everything)).alias("after"))
    heads = after.join(first.select(F.col("stretch").alias("after"), "first"), "after").select("stretch", "first")
    joined = ahead.join(heads, "stretch")
    return joined.withColumns({f"next_{c}": F.when(F.col("closing"), F.col(f"first.{c}")).otherwise(F.col(f"next_{c}")) for c in columns}).drop(
        "closing", "first", "stretch"
    )


def edited_fingerprints(docs: DataFrame, run: RunFolder, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint each text, its edited form and compare it with that and with the next document.

    The edited form has the last third of the code points (rounded down)
    replaced by the first as many of the next document in descending order of
    the integer id (after the last: the first; fewer if that one is shorter).

    Result: the id as ``doc_id``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint`` (roots), ``near_edited`` and
    ``near_next``.  Other columns of the input are not read, so their names do
    not matter.  A null text counts as empty; null ids come last; rows with
    equal ids follow one another by a hash of their texts, equal rows in any
    order, which gives the same rows.  A single row is its own next one.  An
    empty table gives an empty result.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    tree = with_tree(base, "text", "").withColumn("tie", F.xxhash64("text"))
    narrow = tree.select("doc_id", "text", "codes", "root", "tie")
    ahead = with_next(narrow, "doc_id", F.octet_length("text"), ["text", "codes"], [F.col("tie")])
    third = F.floor(F.length("text") / 3).cast("int")
    edited = ahead.withColumn(
        "edited", F.concat(F.substr("text", F.lit(1), F.length("text") - third), F.substr("next_text", F.lit(1), third))
    )
    edited = edited.withColumns({"n_chars": F.length("text").cast("long"), "edited_sha256": F.sha2("edited", 256)})
    both = with_tree(edited.drop("text", "next_text"), "edited", "edited_")
    return both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.col("root").alias("fingerprint"),
        F.col("edited_root").alias("edited_fingerprint"),
        likeness(F.col("codes"), F.col("edited_codes")).alias("near_edited"),
        likeness(F.col("codes"), F.col("next_codes")).alias("near_next"),
    )
