"""Merkle fingerprints over sections, paragraphs and clauses, with SQL functions only.

Sections are separated by an empty line ("\\n\\n"), paragraphs by a line end, clauses by
a blank after one of . ! ? , ; : |. A clause of more than `LONG` code points is cut further, at places that its own
content picks, so texts of any script and layout have leaves that an edit elsewhere leaves alone. A leaf is the SHA-256 of a
clause or of such a piece (all but the first behind a line end, which no clause holds); a paragraph, a section
and the document hash the list of their children, each level with its own prefix. The
splits can be undone, so roots are equal exactly when texts are. `likeness`
compares the distinct leaves of two trees (Dice), which the tree carries and the root alone does not; `differing`
names the branches that differ.

Rules: null text counts as empty (one section, one paragraph, one empty clause). The next
document is the next larger id, the smallest after the largest; a null id sorts first;
of several rows with that id the smallest text stands for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import let, stored

CLAUSE_END = r" (?<=[.!?,;:|] )"


#: Clauses of more code points are cut; about every CUT-th code point ends a piece.
LONG = 200
CUT = 32


def pieces(clause: Column) -> Column:
    """A clause as leaves: itself, or the pieces of a long one. A piece ends where the code
    points of two neighbours add up (the second counted seven times) to 7 modulo `CUT`."""
    def marked(chars: Column) -> Column:
        def mark(c: Column, i: Column) -> Column:
            before = F.ascii(F.when(i > 0, F.get(chars, i - 1)).otherwise(""))
            return F.concat(c, F.when((F.ascii(c) * 7 + before) % CUT == 7, "\n").otherwise(""))

        return F.split(F.array_join(F.transform(chars, mark), ""), "\n")

    return F.when(F.length(clause) > LONG, F.filter(let(F.split(clause, ""), marked), lambda p: p != "")).otherwise(F.array(clause))


def _leaf(piece: Column, i: Column) -> Column:
    return F.sha2(F.when(i > 0, F.concat(F.lit("\n"), piece)).otherwise(piece).cast("binary"), 256)


def tree(text: Column) -> Column:
    """Leaf hashes by section and paragraph."""
    return F.transform(F.split(text, "\n\n"), lambda s: F.transform(F.split(s, "\n"), lambda p: F.flatten(F.transform(
        F.split(p, CLAUSE_END), lambda clause: F.transform(pieces(clause), _leaf)))))


def _node(prefix: str, children: Column) -> Column:
    return F.sha2(F.concat(F.lit(prefix), F.array_join(children, ",")).cast("binary"), 256)


def paragraphs(of: Column) -> Column:
    """Paragraph hashes by section."""
    return F.transform(of, lambda s: F.transform(s, lambda p: _node("p", p)))


def sections(of: Column) -> Column:
    return F.transform(paragraphs(of), lambda s: _node("s", s))


def root(of: Column) -> Column:
    return _node("d", sections(of))


def leaves(of: Column) -> Column:
    return F.array_distinct(F.flatten(F.flatten(of)))


def likeness(a: Column, b: Column) -> Column:
    """Twice the common distinct leaves over all distinct leaves of two leaf lists: 0 to 1."""
    return F.size(F.array_intersect(a, b)) * 2.0 / (F.size(a) + F.size(b))


def differing(a: Column, b: Column) -> Column:
    """(section, paragraph), from 0, of the paragraphs that differ at their place between two trees:
    sections with equal hashes are skipped whole."""
    pa, pb, sa, sb = paragraphs(a), paragraphs(b), sections(a), sections(b)
    none = F.array().cast("array<string>")
    every = F.sequence(F.lit(0), F.greatest(F.size(a), F.size(b)) - 1)

    def within(i: Column) -> Column:
        left, right = F.coalesce(F.get(pa, i), none), F.coalesce(F.get(pb, i), none)
        places = F.sequence(F.lit(0), F.greatest(F.size(left), F.size(right)) - 1)
        return F.transform(F.filter(places, lambda j: ~F.get(left, j).eqNullSafe(F.get(right, j))),
                           lambda j: F.struct(i.alias("section"), j.alias("paragraph")))

    return F.flatten(F.transform(F.filter(every, lambda i: ~F.get(sa, i).eqNullSafe(F.get(sb, i))), within))


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs' columns inside a struct `row`, with tree and fingerprint (the root)."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return (docs.select(row.alias("row"), tree(F.coalesce(F.col("text"), F.lit(""))).alias("tree"))
            .withColumn("fingerprint", root(F.col("tree"))))


def successors(docs: DataFrame) -> DataFrame:
    """doc_id, prev_id: for each distinct id the id before it, the largest before the smallest.
    Ids alone are range-partitioned; within a partition a window finds the neighbour, and one
    row per partition joins the ends."""
    ids = docs.select("doc_id").distinct()
    cut = stored(ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()), "ids")
    edge = cut.groupBy("part").agg(F.max(F.struct("doc_id")).alias("last"))
    every = Window.orderBy("part")  # one row per partition
    ends = edge.select("part", F.lag("last").over(every).alias("before"),
                       F.max("last").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("wrap"))
    own = F.lag(F.struct("doc_id")).over(Window.partitionBy("part").orderBy("doc_id"))
    return (cut.withColumn("own", own).join(ends, "part")
            .select("doc_id", F.coalesce("own", "before", "wrap")["doc_id"].alias("prev_id")))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    # the key has no nulls; both uses of `own` share one exchange, and texts move once more, to the id before
    key = F.coalesce(F.concat(F.lit("#"), F.col("doc_id")), F.lit(""))
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("k")).repartition("k")
    before = F.coalesce(F.concat(F.lit("#"), F.col("prev_id")), F.lit(""))
    order = stored(successors(docs).select(key.alias("k"), before.alias("prev_k")), "order")
    heads = own.groupBy("k").agg(F.min(F.struct("text", "doc_id")).alias("head"))
    nexts = heads.join(order, "k").select(F.col("prev_k").alias("k"), F.col("head.text").alias("next_text"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    both = (own.join(nexts, "k")
            .withColumn("edited", F.concat(F.substring("text", F.lit(1), n - half),
                                           F.substring("next_text", F.lit(1), half)))
            .select("doc_id", n.cast("long").alias("n_chars"),
                    F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                    tree(F.col("text")).alias("t"), tree(F.col("edited")).alias("e"), tree(F.col("next_text")).alias("x")))
    return (both.select("doc_id", "n_chars", "edited_sha256", root(F.col("t")).alias("fingerprint"),
                        root(F.col("e")).alias("edited_fingerprint"),
                        leaves(F.col("t")).alias("lt"), leaves(F.col("e")).alias("le"), leaves(F.col("x")).alias("lx"))
            .select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness(F.col("lt"), F.col("le")).alias("near_edited"),
                    likeness(F.col("lt"), F.col("lx")).alias("near_next")))
