"""Benchmark passages in documents, by a prefix-filtered set join in DataFrame functions only.

An item's windows are its runs of ``size`` words (a shorter item is one window). A window must lie whole in
a document, so of its shingles, ordered by how rare they are in the corpus, the first is a necessary one:
only that prefix is joined. Length and position bounds drop windows that would begin before or end after the
document, and the words of what is left are compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import saved

#: what separates words: ASCII other than 0-9, A-Z and a-z
SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATOR), "")


def exact(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def windows(items: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(item, window): each distinct window of each item, its words joined by blanks."""
    w = items.select(F.col(key).cast("string").alias("item"),
                     words(exact(F.coalesce(F.col(text).cast("string"), F.lit("")))).alias("w"))
    w = w.where(F.col("item").isNotNull() & (F.size("w") > 0))
    starts = w.select("item", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1))))
                      .alias("at"))
    return starts.select("item", F.array_join(F.slice("w", F.col("at"), F.lit(size)), " ").alias("window")).distinct()


def _shingle(parts: list[Column]) -> Column:
    """A hash that equal shingles share; ``lower`` folds more than A-Z, so words are compared again later."""
    return F.xxhash64(F.lit(len(parts)), *[F.lower(p) for p in parts])


def _runs(w: str, longest: int) -> Column:
    """For each word of the array ``w`` a struct of it ("0") and the ones after it ("1", ...), null at the end."""
    return F.arrays_zip(*[F.slice(w, F.lit(k + 1), F.size(w)) for k in range(longest)])


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                 item_key: str = "item_id", item_text: str = "text", size: int = 10, shingle: int = 3,
                 broadcast_rows: int = 500_000) -> DataFrame:
    """One row per row of ``docs``: key, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``,
    ``contaminated``.

    Words are runs of 0-9, A-Z, a-z and non-ASCII characters, A-Z lower-cased. A document word is hit if it
    lies in an occurrence of an item's window. Null texts have no words; items without a key or words have
    no windows; items or documents may repeat; other columns are ignored. Shingles of windows are broadcast
    up to ``broadcast_rows`` of them, and joined by shuffle beyond.
    """
    docs = docs.select(F.col(key).alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("print", F.xxhash64("text"))
    found = windows(items, item_key, item_text, size)
    rows = _hits(docs, found, shingle, broadcast_rows)
    of = (rows.where("n_hit > 0").select("doc", "print", F.explode("windows").alias("window")).distinct()
          .join(found, "window").groupBy("doc", "print").agg(F.sort_array(F.collect_set("item")).alias("items")))
    r, o = rows.alias("r"), of.alias("o")
    joined = r.join(o, F.col("r.doc").eqNullSafe(F.col("o.doc")) & (F.col("r.print") == F.col("o.print")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(F.col("r.doc").alias(key), "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
                         F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
                         (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
          item_text: str = "text", size: int = 10, shingle: int = 3, broadcast_rows: int = 500_000) -> DataFrame:
    """The rows of ``docs`` without a hit word, with all their columns."""
    others = [c for c in docs.columns if c != text]
    source = docs.select(F.struct(F.col(text).isNull().alias("_null"), *others).alias("row"), F.col(key).alias("doc"),
                         F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    source = source.withColumn("print", F.xxhash64("text"))
    found = windows(items, item_key, item_text, size)
    rows = _hits(source, found, shingle, broadcast_rows, keep=True)
    whole = F.when(~F.col("row._null"), F.col("text"))
    return rows.where("n_hit = 0").select(*[whole.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])


def _hits(docs: DataFrame, found: DataFrame, shingle: int, broadcast_rows: int, keep: bool = False) -> DataFrame:
    """(doc, print, n_words, n_hit, windows) of every row of ``docs(doc, print, text)``, as a table; with ``keep``
    (row, text, n_hit) instead, as a plan."""
    one = saved(found.select("window").distinct()
                .select("window", F.split("window", " ").alias("w"))
                .withColumn("len", F.size("w")).withColumn("g", F.least("len", F.lit(shingle)))
                .withColumn("at", F.explode(F.sequence(F.lit(0), F.col("len") - F.col("g"))))
                .select("window", "len", "at", "g", _window_gram(shingle).alias("gram")), "windows")
    lengths = sorted(r.g for r in one.select("g").distinct().collect())  # at most ``shingle`` figures
    grams = one.select("gram").distinct()
    if not lengths:
        return docs.select(
            *(["row", "text"] if keep else []), "doc", "print", F.size(words(F.col("text"))).cast("long").alias("n_words"),
            F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("windows"))
    if one.count() <= broadcast_rows:
        grams = F.broadcast(grams)

    # occurrences of the windows' shingles, and how often each occurs in the corpus
    base = docs.select("doc", "print", words(F.col("text")).alias("w"))
    spread = base.select("doc", "print", F.size("w").alias("n"),
                         F.posexplode(_runs("w", max(lengths))).alias("pos", "z"))
    kinds = [F.when(F.col("z")[str(g - 1)].isNotNull(), _shingle([F.col("z")[str(k)] for k in range(g)]))
             for g in lengths]
    gram = kinds[0] if len(kinds) == 1 else F.explode(F.array(*kinds))
    seen = saved(spread.select("doc", "print", "n", "pos", gram.alias("gram")).join(grams, "gram"), "seen")
    counts = seen.groupBy("gram").count()
    prefix = (one.join(counts, "gram").groupBy("window", "len")
              .agg(F.min(F.struct("count", "gram", "at")).alias("p"), F.count("*").alias("there"))
              # a window with a shingle that the corpus lacks cannot occur
              .where(F.col("there") == F.col("len") - F.least("len", F.lit(shingle)) + 1)
              .select("window", "len", "p.gram", "p.at"))
    start = F.col("pos") - F.col("at")
    candidates = (seen.join(prefix, "gram").where((start >= 0) & (start + F.col("len") <= F.col("n")))
                  .groupBy("doc", "print").agg(F.collect_set(F.struct(start.alias("start"), "len", "window")).alias("c")))

    # exact words of the candidates
    left, right = docs.alias("l"), candidates.alias("r")
    whole = left.join(right, F.col("l.doc").eqNullSafe(F.col("r.doc")) & (F.col("l.print") == F.col("r.print")), "left")
    carried = ["l.row", "l.text"] if keep else []
    whole = whole.select(*carried, "l.doc", "l.print", F.size(words(F.col("l.text"))).cast("long").alias("n_words"),
                         F.when(F.col("r.c").isNotNull(), words(exact(F.col("l.text")))).alias("w"), "r.c")
    same = F.filter("c", lambda x: F.array_join(F.slice(F.col("w"), x["start"] + 1, x["len"]), " ") == x["window"])
    whole = whole.select(*(["row", "text"] if keep else []), "doc", "print", "n_words", same.alias("c"))
    covered = F.array_distinct(F.flatten(F.transform(
        "c", lambda x: F.sequence(x["start"], x["start"] + x["len"] - 1))))
    if keep:
        return whole.select("row", "text", F.coalesce(F.size("c"), F.lit(0)).alias("n_hit"))
    return saved(whole.select("doc", "print", "n_words",
                              F.coalesce(F.when(F.size("c") > 0, F.size(covered)), F.lit(0)).cast("long").alias("n_hit"),
                              F.array_distinct(F.transform("c", lambda x: x["window"])).alias("windows")), "hits")


def _window_gram(shingle: int) -> Column:
    """The hash of the shingle at ``at`` of the window words ``w``."""
    kinds = F.lit(None).cast("long")
    for g in range(1, shingle + 1):
        kinds = F.when(F.col("g") == g, _shingle([F.get("w", F.col("at") + k) for k in range(g)])).otherwise(kinds)
    return kinds
