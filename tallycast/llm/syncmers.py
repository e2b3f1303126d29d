"""Document fingerprints from closed syncmers.

A text is a sequence of symbols: pieces of up to four characters from the start
of every word. A k-mer of ``K`` symbols is a closed syncmer if the smallest hash
among its inner ``S``-mers is its first or its last one. Whether a k-mer is
chosen depends on nothing around it, so an edit elsewhere leaves the anchors of
the rest alone. The fingerprint keeps the ``ANCHORS`` smallest anchor hashes
(a uniform sample of all of the text's anchors) with the position of their first
occurrence; two fingerprints are matched by position: shared anchors count if
they lie at the common offset.

Only DataFrame expressions are used; each text's work is linear in its length
(``let`` binds the intermediate arrays, so that no lambda evaluates them again).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ordered_ranks, stored

K, S = 5, 2
ANCHORS = 32
POSITION_BITS = 23
DRIFT = 16  # symbols that an anchor may lie off the common offset


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def symbols(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"\S{1,4}"), F.lit(0))


def _packed(h: Column, position: Column) -> Column:
    """40 bits of hash, then the position: sorts by hash, then by first occurrence."""
    at = F.least(position.cast("long"), F.lit((1 << POSITION_BITS) - 1))
    return F.shiftleft(F.shiftrightunsigned(h, 24), POSITION_BITS).bitwiseOR(at)


def anchors(text: Column) -> Column:
    """array<long>: hash and position of every closed syncmer of a text. A text of
    fewer than ``K`` symbols is one anchor; one of none has no anchor."""
    w = K - S + 1

    def chosen(h, g):
        def at(i):
            edge = F.least(F.get(g, i), F.get(g, i + (w - 1)))
            inner = F.least(*[F.get(g, i + j) for j in range(1, w - 1)])
            kmer = F.xxhash64(F.get(g, i), F.get(g, i + S), F.get(h, i + (K - 1)))
            return F.when(edge <= inner, _packed(kmer, i))
        return F.filter(F.transform(F.sequence(F.lit(0), F.size(h) - K), at), lambda x: x.isNotNull())

    def of(h):
        smers = F.transform(F.sequence(F.lit(0), F.size(h) - S), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1)))
        short = F.array(_packed(F.xxhash64(h, F.lit("short")), F.lit(0)))
        return (F.when(F.size(h) == 0, F.array().cast("array<bigint>")).when(F.size(h) < K, short)
                .otherwise(let(smers, lambda g: chosen(h, g))))

    return let(F.transform(symbols(text), lambda s: F.xxhash64(s)), of)


def sketch(text: Column) -> Column:
    """array<long>: the ``ANCHORS`` smallest distinct anchors with their first positions, sorted."""
    hash_of = lambda x: F.shiftright(x, POSITION_BITS)
    first = lambda a: F.filter(a, lambda x, i: (i == 0) | (hash_of(x) != hash_of(F.get(a, i - 1))))
    return F.slice(let(F.array_sort(anchors(text)), first), 1, ANCHORS)


def fingerprint(sk: Column) -> Column:
    """A sketch as text: 16 hex digits per anchor."""
    return F.array_join(F.transform(sk, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """How alike two sketches are, 0 to 1: among the smallest anchors of both
    texts together, the share that both have at the common offset (the median of
    the shared anchors' offsets). Two texts without anchors are alike."""
    hashes = lambda x: F.transform(x, lambda v: F.shiftright(v, POSITION_BITS))
    place = lambda x: F.transform(x, lambda v: v.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)))

    def body(s):
        union = F.slice(F.array_sort(F.array_union(s["ha"], s["hb"])), 1, ANCHORS)
        both = F.array_intersect(union, F.array_intersect(s["ha"], s["hb"]))
        offset = F.transform(both, lambda h: F.get(s["pa"], F.array_position(s["ha"], h).cast("int") - 1) - F.get(s["pb"], F.array_position(s["hb"], h).cast("int") - 1))

        def agree(o):
            mid = F.get(o, F.floor(F.size(o) / 2).cast("int"))
            return let(mid, lambda m: F.size(F.filter(o, lambda x: F.abs(x - m) <= DRIFT)))

        n = F.greatest(F.size(union), F.lit(1))
        return F.when((F.size(s["ha"]) == 0) & (F.size(s["hb"]) == 0), F.lit(1.0)).otherwise(let(F.array_sort(offset), agree) / n)

    return let(F.struct(hashes(a).alias("ha"), hashes(b).alias("hb"), place(a).alias("pa"), place(b).alias("pb")), body)


NO_ID = -(1 << 63)


def keyed(docs: DataFrame) -> DataFrame:
    """(id, h, text): the id (a null one as the smallest number) and the text's hash name a document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))


def successors(documents: DataFrame) -> DataFrame:
    """(id, h, n, next_id, next_h) for distinct (id, h, n): the next one in ascending order, after the last the first."""
    ranks = stored(ordered_ranks(documents, [F.col("id"), F.col("h")], "rank"), "syncmer-ranks")
    before = F.pmod(F.col("rank") - 1, F.lit(max(ranks.count(), 1)))
    after = ranks.select(F.col("id").alias("next_id"), F.col("h").alias("next_h"), before.alias("rank"))
    return ranks.join(after, "rank").select("id", "h", "n", "next_id", "next_h")


def spliced(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_chars, edited_sha256, sketch,
    edited_sketch, next_sketch). The edited text has its last half replaced by as
    much of the beginning of the next document's (all of it, if it is shorter).

    A null text is empty. Documents are ordered by id, a null one first; rows
    with the same id and different texts follow each other in a fixed order;
    rows that repeat id and text are one document and get a row each. Other
    columns are ignored; a single document is its own next; an empty table gives
    an empty table. Texts are shuffled once, and of each the part that its
    predecessor takes.
    """
    texts = keyed(docs)
    first = stored(texts.select("id", "h", F.length("text").cast("long").alias("n"), sketch(F.col("text")).alias("sketch")), "syncmer-sketches")
    documents = stored(first.groupBy("id", "h").agg(F.max("n").alias("n"), F.count("*").alias("rows")), "syncmer-ids")
    repeats = not documents.filter("rows > 1").isEmpty()
    once = (lambda df, *keys: df.dropDuplicates(list(keys))) if repeats else (lambda df, *keys: df)
    needs = successors(documents.select("id", "h", "n")).select(
        F.col("next_id").alias("id"), F.col("next_h").alias("h"), F.col("id").alias("for_id"), F.col("h").alias("for_h"), F.floor(F.col("n") / 2).cast("int").alias("need"))
    own = texts.join(once(first.select("id", "h", "sketch"), "id", "h"), ["id", "h"])
    lent = once(own.join(needs, ["id", "h"]).select("for_id", "for_h", F.substring("text", F.lit(1), F.col("need")).alias("lent"),
                                                    F.col("sketch").alias("next_sketch")), "for_id", "for_h")
    both = own.join(lent, (F.col("id") == F.col("for_id")) & (F.col("h") == F.col("for_h")))
    n = F.length("text")
    edited = both.select(F.nullif(F.col("id"), F.lit(NO_ID)).alias("doc_id"), n.cast("long").alias("n_chars"), "sketch", "next_sketch",
                         F.concat(F.substring("text", F.lit(1), (n - F.floor(n / 2)).cast("int")), F.col("lent")).alias("edited"))
    return edited.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "sketch", sketch(F.col("edited")).alias("edited_sketch"), "next_sketch")


def compare(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row (see ``spliced``)."""
    return spliced(docs).select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("sketch")).alias("fingerprint"), fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
