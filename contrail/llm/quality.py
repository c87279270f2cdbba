"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is of order ``ORDER`` over UTF-8 bytes, trained on the whole text of
every trusted document. Counts, continuation counts, discounts and
probabilities are DataFrame aggregations and joins on packed n-grams, sharded
by n-gram. Documents add up the log probabilities of their n-grams: those of
the most frequent seen n-grams come from a broadcast table of fixed size
``HOT`` during the scan; every other n-gram is scored once for the whole corpus
by joins along the backoff chain and joined back to its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import ROW, table, with_row
from contrail.session import materialize

ORDER = 5
#: Rows of the broadcast table of log probabilities (12 bytes each).
HOT = 300_000
#: One in ``FIT`` trusted documents, by hash of the id, is not trained on: limits are quantiles of their perplexities
#: (trained text scores lower than unseen text of the same kind).
FIT = 5
#: Levels that the labels choose from, loosest first; no lower limit at level 0.
UPPER = (0.995, 0.99, 0.975, 0.95, 0.925, 0.9)
LOWER = (0.0, 0.005, 0.02)
#: A language's own limits weigh n / (n + SMOOTH) with n trusted documents in the fit split, those over all languages the rest;
#: likewise its shares of bad documents.
SMOOTH = 10
BYTES = 256
PIECE = 1 << 20


def packed(data: bytes, order: int = ORDER) -> np.ndarray:
    """Every byte with the ``order - 1`` before it (zeros before the text), packed into one integer each."""
    codes = np.frombuffer(data, np.uint8).astype(np.int64)
    out = codes.copy()
    for back in range(1, min(order, len(codes))):
        out[back:] |= codes[:-back] << (8 * back)
    return out


def pieces(data: bytes, order: int = ORDER) -> Iterator[np.ndarray]:
    """``packed`` in bounded pieces of a text."""
    for at in range(0, len(data), PIECE):
        lead = min(at, order - 1)
        yield packed(data[at - lead:at + PIECE], order)[lead:]


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, n) of all n-grams of ``texts(text binary)``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            grams, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.int64),) * 2
            return pa.RecordBatch.from_arrays([pa.array(grams, pa.int64()), pa.array(n, pa.int64())], ["gram", "n"])

        for batch in batches:
            for text in batch.column(0):
                for part in pieces(text.as_py() or b""):
                    held.append(part)
                    size += len(part)
                    if size > 1 << 23:
                        yield out()
                        held, size = [], 0
        yield out()

    return texts.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def low(gram, order: int):
    """The last ``order`` bytes of a packed n-gram."""
    return gram.bitwiseAND(F.lit((1 << (8 * order)) - 1))


def discounts(counts: DataFrame) -> list[float]:
    """D1, D2 and D3+ of a table's counts (the usual estimates, kept within 0 and the count)."""
    row = counts.agg(*[F.count_if(F.col("n") == i).alias(f"n{i}") for i in range(1, 5)]).first()
    n1, n2, n3, n4 = (float(x or 0) for x in row)
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.05), i + 0.95) for i, d in enumerate(raw)]


def train(spark: SparkSession, texts: DataFrame, order: int = ORDER) -> dict[int, tuple[DataFrame, DataFrame]]:
    """For each order 1..``order``: seen n-grams ``(gram, n, p)`` and their contexts ``(context, gamma)``, both written tables.

    The highest order counts occurrences, lower ones distinct left extensions.
    """
    counts = {order: materialize(spark, gram_counts(texts), "kn-counts")}
    kinds = counts[order].select("gram")
    for k in range(order - 1, 0, -1):
        counts[k] = materialize(spark, kinds.groupBy(low(F.col("gram"), k).alias("gram")).agg(F.count("*").alias("n")), "kn-counts")
        kinds = counts[k].select("gram")
    model: dict[int, tuple[DataFrame, DataFrame]] = {}
    for k in range(1, order + 1):
        cut = discounts(counts[k])
        off = F.when(F.col("n") == 1, cut[0]).when(F.col("n") == 2, cut[1]).otherwise(cut[2])
        rows = counts[k].withColumn("context", F.shiftright("gram", 8)).withColumn("off", off)
        sums = rows.groupBy("context").agg(F.sum("n").alias("total"), F.sum("off").alias("freed"))
        sums = materialize(spark, sums.select("context", "total", (F.col("freed") / F.col("total")).alias("gamma")), "kn-contexts")
        below = F.lit(1.0 / BYTES)
        rows = rows.join(sums, "context")
        if k > 1:
            rows = rows.withColumn("shorter", low(F.col("gram"), k - 1)).join(
                model[k - 1][0].select(F.col("gram").alias("shorter"), F.col("p").alias("q")), "shorter")
            below = F.col("q")
        p = (F.col("n") - F.col("off")) / F.col("total") + F.col("gamma") * below
        model[k] = (materialize(spark, rows.select("gram", "n", p.alias("p")), "kn-grams"), sums.select("context", "gamma"))
    return model


def log_probability(model: dict[int, tuple[DataFrame, DataFrame]], grams: DataFrame) -> DataFrame:
    """(gram, logp) for distinct n-grams, seen or not, by joins from the lowest order up."""
    out = grams.withColumn("p", F.lit(1.0 / BYTES))
    for k, (seen, contexts) in sorted(model.items()):
        out = (out.withColumn("key", low(F.col("gram"), k)).withColumn("context", F.shiftright("key", 8))
               .join(seen.select(F.col("gram").alias("key"), F.col("p").alias("direct")), "key", "left")
               .join(contexts, "context", "left")
               .withColumn("p", F.coalesce("direct", F.col("p") * F.coalesce("gamma", F.lit(1.0))))
               .select("gram", "p"))
    return out.select("gram", F.log("p").alias("logp"))


FACTOR = 0x9E3779B97F4A7C15


def slots(grams: np.ndarray, bits: int) -> np.ndarray:
    return ((grams.astype(np.uint64) * np.uint64(FACTOR)) >> np.uint64(64 - bits)).astype(np.int64)


def hot_table(grams: np.ndarray, values: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Log probabilities by slot of the packed n-gram; of n-grams that meet in a slot one stays, the others are not hot."""
    bits = max(4, int(len(grams) * 3).bit_length())
    keys, held = np.full(1 << bits, -1, np.int64), np.full(1 << bits, np.nan)
    place, first = np.unique(slots(grams, bits), return_index=True)
    keys[place], held[place] = grams[first], values[first]
    return bits, keys, held


def find(known: tuple[int, np.ndarray, np.ndarray], grams: np.ndarray) -> np.ndarray:
    """Log probabilities of n-grams, NaN where they are not hot."""
    bits, keys, held = known
    at = slots(grams, bits)
    return np.where(keys[at] == grams, held[at], np.nan)


def perplexities(spark: SparkSession, docs: DataFrame, model: dict[int, tuple[DataFrame, DataFrame]], hot: int = HOT) -> DataFrame:
    """``__llm_row, n_bytes, logp`` of every row of ``docs(__llm_row, text binary)``."""
    seen = model[max(model)][0]
    top = seen.orderBy(F.desc("n"), "gram").limit(hot).select("gram", "p").toPandas()
    known = spark.sparkContext.broadcast(hot_table(top["gram"].to_numpy(np.int64), np.log(top["p"].to_numpy(np.float64))))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = known.value
        for batch in batches:
            sizes, sums, rest, times = [], [], [], []
            for text in batch.column(1):
                text = text.as_py() or b""
                total, missed = 0.0, []
                for part in pieces(text):
                    value = find(table_, part)
                    absent = np.isnan(value)
                    total += float(value[~absent].sum())
                    missed.append(part[absent])
                grams, n = np.unique(np.concatenate(missed), return_counts=True) if missed else (np.zeros(0, np.int64),) * 2
                sizes.append(len(text))
                sums.append(total)
                rest.append(grams)
                times.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sums, pa.float64()), pa.array(rest, pa.list_(pa.int64())),
                 pa.array(times, pa.list_(pa.int64()))], [ROW, "n_bytes", "logp", "grams", "times"])

    partly = materialize(spark, docs.select(ROW, "text").mapInArrow(
        add_up, f"{ROW} long, n_bytes long, logp double, grams array<long>, times array<long>"), "kn-docs")
    rest = partly.select(ROW, F.explode(F.arrays_zip("grams", "times")).alias("g")).select(
        ROW, F.col("g.grams").alias("gram"), F.col("g.times").alias("times"))
    scored = materialize(spark, log_probability(model, rest.groupBy("gram").agg(F.lit(1).alias("one")).select("gram")), "kn-rest")
    more = rest.join(scored, "gram").groupBy(ROW).agg(F.sum(F.col("logp") * F.col("times")).alias("more"))
    return partly.select(ROW, "n_bytes", "logp").join(more, ROW, "left").select(
        ROW, "n_bytes", (F.col("logp") + F.coalesce("more", F.lit(0.0))).alias("logp"))


def part(doc_id="doc_id"):
    """0 to ``FIT`` - 1 by hash of the id: 0 is the fit split."""
    return F.pmod(F.xxhash64(F.col(doc_id).cast("string")), F.lit(FIT))


def levels_reached(ppl, limits) -> list:
    """Documents over each upper limit and under each lower one of ``limits`` (in order of UPPER, LOWER).

    Under a lower one count low-quality documents only: it is there for text that repeats itself.
    """
    last = len(UPPER)
    return [F.count_if(ppl > F.get(limits, F.lit(i))) for i in range(last)] + [
        F.count_if(F.col("low") & (ppl < F.get(limits, F.lit(last + i)))) if level else F.lit(0) for i, level in enumerate(LOWER)]


def chosen(limits, shares: list, at: int, levels: tuple[float, ...], cost) -> object:
    """The limit at the level whose share of bad documents exceeds its share of trusted ones most, of equal ones the loosest."""
    gains = F.array(*[F.coalesce(shares[at + i], F.lit(0.0)) - F.lit(cost(level)) for i, level in enumerate(levels)])
    return F.get(limits, F.lit(at) + F.array_position(gains, F.array_max(gains)).cast("int") - 1)


def language_limits(spark: SparkSession, fit: DataFrame) -> tuple[DataFrame, float | None, float | None]:
    """Upper and lower limit by language, ``of, upper, lower``, and over all languages, from ``fit(of, ppl, good, low)``.

    Quantiles of the trusted documents (good), those of a language and those of all weighed by ``SMOOTH``, at the
    levels that gain most on the bad ones.
    """
    last, bad = len(UPPER), fit.where("NOT good")
    at = F.percentile_approx("ppl", [*UPPER, *LOWER], 10000)
    overall = fit.where("good").agg(at.alias("limits")).first().limits  # one row
    if overall is None:
        return spark.createDataFrame([], "of string, upper double, lower double"), None, None
    every = F.array(*[F.lit(float(x)) for x in overall])
    counts = bad.agg(F.count("*").alias("n"), F.array(*levels_reached(F.col("ppl"), every)).alias("hit")).first()
    shares = [F.lit(x / counts.n if counts.n else 0.0) for x in counts.hit]

    def pick(limits, shares):
        lower = chosen(limits, shares, last, LOWER, lambda q: q)
        return (chosen(limits, shares, 0, UPPER, lambda q: 1 - q).alias("upper"),
                F.when(lower > F.get(limits, F.lit(last)), lower).alias("lower"))

    one = spark.range(1).select(*pick(every, shares)).first()
    own = fit.where("good AND of IS NOT NULL").groupBy("of").agg(F.count("*").alias("docs"), at.alias("limits"))
    weight = F.col("docs") / (F.col("docs") + F.lit(SMOOTH))
    own = own.withColumn("limits", F.zip_with("limits", every, lambda a, b: F.exp(weight * F.log(a) + (1 - weight) * F.log(b))))
    own = materialize(spark, own, "kn-limits")
    hit = bad.join(own, "of").groupBy("of").agg(F.count("*").alias("n"), F.array(*levels_reached(F.col("ppl"), F.col("limits"))).alias("hit"))
    n = F.coalesce("n", F.lit(0))
    by = [(F.coalesce(F.get("hit", F.lit(i)), F.lit(0)) + SMOOTH * share) / (n + SMOOTH) for i, share in enumerate(shares)]
    limits = own.join(hit, "of", "left").select("of", *pick(F.col("limits"), by))
    return materialize(spark, limits, "kn-limits"), one.upper, one.lower


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, hot: int = HOT) -> DataFrame:
    """Quality of every row of ``docs(doc_id, text, lang)``, whole texts, learned from ``labels(doc_id, quality, toxic)``.

    Trusted are documents labelled quality 1 and not toxic, bad those with another quality or toxic. The model is
    trained on the trusted documents but one in ``FIT``; those and the bad ones choose the limits. Columns ``__llm_row,
    doc_id, lang, n_bytes, perplexity`` (per byte), ``threshold, floor`` (limits in the row's language, the floor null
    if the labels ask for none; over all languages for a null one or one without trusted text in the fit split) ``, keep``. Null or empty text has null
    perplexity and is not kept; without trusted text in the fit split nothing can be judged: null threshold, every
    text is kept. Several labels of an id count as trusted if any is.
    """
    rows = with_row(docs.select("doc_id", "text", "lang")).select(ROW, "doc_id", F.col("lang").cast("string").alias("lang"),
                                                                F.col("text").cast("binary").alias("text"))
    trusted = F.coalesce((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), F.lit(False))
    judged = labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)").groupBy("doc_id").agg(
        F.max(trusted).alias("good"), F.max(F.coalesce((F.col("quality") != 1) | (F.col("toxic") != 0), F.lit(False))).alias("bad"),
        F.max(F.coalesce(F.col("quality") != 1, F.lit(False))).alias("low"))
    judged = judged.where("good OR bad").select("doc_id", "good", "low", (~F.col("good") | (part() == 0)).alias("fit"))
    judged = materialize(spark, judged, "kn-trusted").hint("merge")  # the same join at every size: labels grow with the corpus
    ids = materialize(spark, rows.select(ROW, "doc_id", "lang").join(judged.where("fit"), "doc_id").select(ROW, F.col("lang").alias("of"), "good", "low"), "kn-rows")
    model = train(spark, rows.select("doc_id", "text").join(judged.where("NOT fit"), "doc_id", "left_semi").select("text"))
    logs = materialize(spark, perplexities(spark, rows, model, hot), "kn-logp")
    own = F.when(F.col("n_bytes") > 0, F.exp(-F.col("logp") / F.col("n_bytes")))
    fit = materialize(spark, logs.join(ids, ROW).where("n_bytes > 0").select("of", own.alias("ppl"), "good", "low"), "kn-fit")
    limits, upper, lower = language_limits(spark, fit)
    out = rows.drop("text").join(logs, ROW).withColumn("perplexity", own)
    out = out.join(limits, F.col("lang") == F.col("of"), "left")
    known = F.col("of").isNotNull()
    out = out.withColumn("threshold", F.when(known, F.col("upper")).otherwise(F.lit(upper).cast("double")))
    out = out.withColumn("floor", F.when(known, F.col("lower")).otherwise(F.lit(lower).cast("double")))
    within = F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)) & F.coalesce(F.col("perplexity") >= F.col("floor"), F.lit(True))
    return out.select(ROW, "doc_id", "lang", "n_bytes", "perplexity", "threshold", "floor", (F.col("perplexity").isNotNull() & within).alias("keep"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop(ROW)
