"""Quote folding of a thread: line ranges that repeat what was said before.

Everything is columns: coverage comes from runs in blocks (``runs``), runs of foldable
lines from gaps and islands inside a message, labels from aggregates. The result is
ranges of lines, not markup.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import norm_word, norm_words, scrub_control
from ..session import materialize
from .shingles import earlier_sayers

SHINGLE, LINE_WORDS, COVERED_WORDS, VISIBLE_WORDS, SIGNATURE_LINES = 6, 4, 12, 3, 8

# --- fixed values: what mail programs put around a quote
_FIELDS = "From|Von|De|Da|Van|Fra|Från|Sent|Gesendet|Date|Envoy[eé]e?|Enviad[oa]|Inviat[oa]|Verzonden|Sendt|Skickat|To|An|Aan|Til|À|Cc|Bcc|Subject|Betreff|Objet|Asunto|Oggetto|Onderwerp|Assunto|Emne|Ämne|Reply-To"
_FROM_FIELDS = ("from", "von", "de", "da", "van", "fra", "från")
_VERBS = "wrote|schrieb|escribi[oó]|escreveu|skrev|ha scritto|a [eé]crit"
_ORIGINALS = "Original Message|Ursprüngliche Nachricht|Message d'origine|Mensaje original|Messaggio originale|Oorspronkelijk bericht|Oprindelig meddelelse|Ursprungligt meddelande|Opprinnelig melding"
HEADER = rf"(?iu)^\s*({_FIELDS})\s*:\s+\S"
ATTRIBUTION = rf"(?iu)^\s*(On|Le|El|Am|Op|Den|P[aå]|Il giorno)\b.*({_VERBS})\s*:?\s*$"
TAIL = rf"(?iu)(?:{_VERBS}|writes)\s*:\s*$"
OTHERS = (
    rf"(?iu)^\s*[-_*=]{{2,}}\s*({_ORIGINALS})?\s*[-_*=]*\s*$",
    r"(?iu)^\s*(WARNUNG:\s*Diese E-?Mail kam von außerhalb der Organisation|CAUTION:\s*This (email|message) originated from outside|WARNING:\s*This (email|message) (came|originated) from outside|\[?EXTERNAL (EMAIL|MESSAGE)\]?)\b",
    r"^\s*>+\s*$",
    r"(?iu)^\s*(?:[\[<(]\s*(?:sni+p+e?d?|cut|deleted|trimmed|\.\.\.)\s*[\]>)]|sni+p+e?d?!*)\s*$",
)
EMOTICON = r"[:;8][-^o']?[()\[\]DPpd/\\|]|\(-?[:;]|\^\^|<3"
# --- end of fixed values


def is_furniture(line: Column) -> Column:
    """Attribution, separator, banner, bare quote mark, elision, or nothing to read but a smiley."""
    words = F.size(F.filter(F.split(line, r"\s+"), lambda w: w != ""))
    silent = (F.trim(line) != "") & ~line.rlike(r"[\p{L}\p{N}]") & ~line.rlike(EMOTICON)
    out = line.rlike(ATTRIBUTION) | (line.rlike(TAIL) & (words <= 16)) | silent
    for p in OTHERS:
        out = out | line.rlike(p)
    return out


def _by_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (thread, message, latest, first, starts, words, word counts by line): covered words by line, and by line and run."""
    for batch in batches:
        starts, words, sizes = (batch.column(i) for i in (4, 5, 6))
        counts, marks = [], []
        for i in range(batch.num_rows):
            s, w, nw = (c[i].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in (starts, words, sizes))
            k = np.repeat(np.arange(len(s)), w)
            # A run is the first to cover its last words.
            pos = np.arange(len(k)) - np.repeat(np.cumsum(w) - w, w) + np.repeat(s + SHINGLE - w, w)
            line = np.searchsorted(np.cumsum(nw), pos, "right")
            counts.append(np.bincount(line, minlength=len(nw)).astype(np.int32))
            at = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (line[1:] != line[:-1])])
            marks.append(np.stack([line[at], k[at], np.diff(np.r_[at, len(k)]), pos[at]]).astype(np.int32))
        flat = np.concatenate(marks, axis=1) if marks else np.zeros((4, 0), np.int32)
        of = pa.array(np.cumsum([0, *[m.shape[1] for m in marks]]).astype(np.int32))
        entries = pa.StructArray.from_arrays([pa.array(c) for c in flat], names=["line", "k", "n", "pos"])
        nc = pa.array(counts, pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], nc, pa.ListArray.from_arrays(of, entries)], names=[*batch.schema.names[:4], "nc", "marks"])


def fold_ranges(messages: DataFrame, thread: str = "thread", message: str = "idx", author: str = "author", body: str = "body") -> DataFrame:
    """(thread, message, line_from, line_to, source, kind): kind "q" (quoted) or "sig" (a repeated signature).

    ``message`` orders a thread. ``source`` is the message that is quoted. A message
    that would keep fewer than three visible words is not folded; null bodies give
    no ranges.
    """
    keys = [thread, message]
    body_text = scrub_control(F.coalesce(body, F.lit("")))
    plain = F.regexp_replace(F.lower(body_text), r"[^\p{L}\p{N}\s]", "")
    word_counts = F.transform(F.split(plain, "\n", -1), lambda t: F.size(F.array_remove(F.split(t, r"\s+"), "")))

    # Words stay in their message's arrays: only runs with a source, and then counts by line, become rows.
    # Three results are read several times each; written once, they cut the plan into short ones.
    said = earlier_sayers(messages.select(*keys, plain.alias("_plain")), F.array_remove(F.split("_plain", r"\s+"), ""), thread, message, SHINGLE)
    said = said.join(messages.select(*keys, word_counts.alias("_nw")), keys)
    kinds = {c: said.schema[c].dataType.simpleString() for c in said.columns}
    parts = [*keys, "latest", "first"]
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in parts) + ", nc array<int>, marks array<struct<line:int,k:int,n:int,pos:int>>"
    covered = materialize(said.select(*parts, "starts", "words", "_nw").mapInArrow(_by_line, schema), "fold-covered")
    of = lambda c: F.get(F.col(c), F.col("_m.k")).alias(c)
    spans = covered.select(*parts, F.explode("marks").alias("_m")).select(*keys, "_m.line", "_m.n", "_m.pos", of("latest"), of("first"))

    none = F.array().cast("array<int>")
    texts = messages.select(*keys, F.split(body_text, "\n", -1).alias("text"), word_counts.alias("nw")).join(covered.select(*keys, "nc"), keys, "left")
    lines = texts.select(*keys, F.posexplode(F.arrays_zip("text", "nw", F.coalesce("nc", none).alias("nc"))).alias("line", "_l")).select(*keys, "line", "_l.*").fillna(0, ["nw", "nc"])
    lines = lines.withColumn("blank", F.trim(F.regexp_replace("text", r"(?U)\s+", " ")) == "").withColumn("field", F.lower(F.regexp_extract("text", HEADER, 1)))
    in_order = Window.partitionBy(*keys).orderBy("line")
    # Header blocks: header lines with blanks between, of two fields at least, one of them a sender's.
    lines = lines.withColumn("_h", (F.col("field") != "") | F.col("blank"))
    lines = lines.withColumn("_hb", F.sum(F.when(F.col("_h") & (F.col("field") != "") & ~F.coalesce(F.lag("_h").over(in_order), F.lit(False)), 1).when(~F.col("_h"), 1).otherwise(0)).over(in_order))
    block = Window.partitionBy(*keys, "_hb", "_h")
    first_field = F.min(F.when(F.col("field") != "", F.col("line"))).over(block)
    is_block = F.col("_h") & (F.sum((F.col("field") != "").cast("int")).over(block) >= 2) & F.max(F.col("field").isin(*_FROM_FIELDS)).over(block) & (F.col("line") >= first_field)
    lines = lines.withColumn("header", is_block)
    lines = lines.withColumn("furn", F.col("header") | is_furniture(F.col("text"))).withColumn("exact", (F.col("nw") > 0) & (F.col("nc") == F.col("nw")))
    lines = lines.withColumn("safe", F.col("blank") | F.col("furn") | F.col("exact"))
    word_count = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    lines = lines.withColumn("attrib", F.col("text").rlike(ATTRIBUTION) | (F.col("text").rlike(TAIL) & (word_count <= 16)) | (F.col("header") & F.col("field").isin(*_FROM_FIELDS)))
    lines = lines.withColumn("run", F.sum((~F.col("safe")).cast("int")).over(in_order))
    last_text = F.max(F.when(~F.col("blank"), F.col("line"))).over(Window.partitionBy(*keys))
    hay = F.when(F.col("attrib"), F.concat(F.lit(" "), F.array_join(norm_words(F.col("text")), " "), F.lit(" ")))
    kept = [*keys, "line", "nw", "nc", "blank", "furn", "exact", "safe", "attrib", "run"]
    lines = materialize(lines.select(*kept, last_text.alias("_last"), hay.alias("_hay")), "fold-lines")

    safe = lines.where("safe")
    plans = safe.groupBy(*keys, "run").agg(
        F.min("line").alias("line_from"), F.max("line").alias("line_to"), F.min(F.when(F.col("exact"), F.col("line"))).alias("first"),
        F.sum("nc").alias("covered"), F.sum(F.col("exact").cast("int")).alias("covered_lines"), F.max((F.col("exact") & (F.col("nw") >= LINE_WORDS))).alias("strong"),
        F.min(F.when(F.col("furn"), F.col("line"))).alias("first_furn"), F.max("_last").alias("_last"), F.min(F.when(F.col("attrib"), F.col("line"))).alias("att"),
    )
    led, trailing = F.coalesce(F.col("first_furn") < F.col("first"), F.lit(False)), F.col("line_to") >= F.coalesce("_last", F.lit(-1))
    plans = plans.where(F.col("first").isNotNull() & (F.col("covered") >= COVERED_WORDS) & ((F.col("covered_lines") >= 2) | led | trailing) & (F.col("strong") | (F.col("covered_lines") >= 2)))

    # The head above an attribution line: the author's own signature, or text that unseats the name.
    inside = safe.join(plans.select(*keys, "run", "att"), [*keys, "run"])
    head = inside.groupBy(*keys, "run").agg(
        F.max(F.col("exact") & ~F.col("furn") & (F.col("line") < F.col("att"))).alias("head_prose"), F.coalesce(F.sum(F.when(F.col("line") < F.col("att"), F.col("nc"))), F.lit(0)).alias("head_cov"),
        F.coalesce(F.sum(F.when((F.col("line") < F.col("att")) & ~F.col("blank"), 1)), F.lit(0)).alias("head_lines"), F.max(F.col("exact") & (F.col("line") >= F.col("att"))).alias("body_prose"),
    )
    authors = messages.select(F.col(thread).alias("_t"), F.col(message).alias("_m"), F.col(author).alias("_a"))
    of_run = lines.select(*keys, "line", "run", "safe").where("safe").drop("safe")
    marked = spans.join(of_run, [*keys, "line"]).join(plans.select(*keys, "run", "att"), [*keys, "run"])
    own = authors.select(F.col("_t").alias(thread), F.col("_m").alias(message), F.col("_a").alias("_own"))
    introduced = marked.where("line < att").join(authors, (F.col(thread) == F.col("_t")) & (F.col("first") == F.col("_m"))).join(own, keys)
    mine = introduced.groupBy(*keys, "run").agg(F.min(F.col("_a").eqNullSafe(F.col("_own"))).alias("all_own"))
    plans = plans.join(head, [*keys, "run"]).join(mine, [*keys, "run"], "left")
    sig = F.coalesce(F.col("head_prose"), F.lit(False)) & (F.col("head_cov") >= COVERED_WORDS) & (F.col("covered") - F.col("head_cov") >= COVERED_WORDS) & (F.col("head_lines") <= SIGNATURE_LINES) & F.coalesce("all_own", F.lit(True)) & F.coalesce("body_prose", F.lit(False))
    plans = plans.withColumn("sig", F.coalesce(sig, F.lit(False))).withColumn("may_name", F.coalesce("sig", F.lit(False)) | ~F.coalesce("head_prose", F.lit(False)))
    plans = materialize(plans, "fold-plans")

    # An attribution that names exactly one earlier author; the latest message of that name is meant.
    spoken = lines.select(*keys, F.col("line").alias("att"), "_hay")
    names = messages.select(F.col(thread).alias("_t"), F.col(message).alias("_m"), F.array_join(norm_words(F.col(author)), " ").alias("_name")).where("_name <> ''")
    called = plans.where("att is not null and may_name").select(*keys, "run", "att").join(spoken, [*keys, "att"])
    hits = called.join(names, (F.col(thread) == F.col("_t")) & (F.col("_m") < F.col(message)) & F.contains("_hay", F.concat(F.lit(" "), F.col("_name"), F.lit(" "))))
    named = hits.groupBy(*keys, "run").agg(F.countDistinct("_name").alias("_k"), F.max("_m").alias("named")).where("_k = 1").drop("_k")

    plans = plans.join(named, [*keys, "run"], "left")
    quote_from = F.when(F.col("sig"), F.col("att")).otherwise(F.col("line_from"))
    quotes = plans.select(*keys, "run", quote_from.alias("line_from"), "line_to", "named", F.lit("q").alias("kind"))
    sigs = plans.where("sig").select(*keys, "run", "line_from", (F.col("att") - 1).alias("line_to"), F.lit(None).cast(messages.schema[message].dataType).alias("named"), F.lit("sig").alias("kind"))
    ranges = quotes.unionByName(sigs)

    # The dominant source; the first word met decides among equals. A signature's is who introduced it.
    sources = marked.join(ranges.select(*keys, "run", "line_from", "line_to", "kind"), [*keys, "run"]).where("line between line_from and line_to")
    votes = sources.groupBy(*keys, "run", "kind", F.when(F.col("kind") == "sig", F.col("first")).otherwise(F.col("latest")).alias("_s")).agg(F.sum("n").alias("_n"), F.min("pos").alias("_p"))
    best = votes.groupBy(*keys, "run", "kind").agg(F.max_by("_s", F.struct("_n", -F.col("_p"))).alias("_source"))
    ranges = ranges.join(best, [*keys, "run", "kind"], "left").withColumn("source", F.coalesce("named", "_source"))

    hidden = lines.join(ranges.select(*keys, "line_from", "line_to"), keys).where("line between line_from and line_to").groupBy(*keys).agg(F.sum("nw").alias("_hidden"))
    total = lines.groupBy(*keys).agg(F.sum("nw").alias("_total"))
    fine = total.join(hidden, keys).where(F.col("_total") - F.col("_hidden") >= VISIBLE_WORDS).select(*keys)
    return ranges.join(fine, keys, "left_semi").select(*keys, "line_from", "line_to", "source", "kind")


def fold_quality(ranges: DataFrame, words: DataFrame) -> DataFrame:
    """folds, folded messages, and messages in all: one row of measures."""
    a = ranges.agg(F.count(F.lit(1)).alias("folds"), F.coalesce(F.sum((F.col("kind") == "sig").cast("long")), F.lit(0)).alias("signatures"))
    return a.join(F.broadcast(words.agg(F.count(F.lit(1)).alias("messages"))))


__all__ = ["fold_quality", "fold_ranges", "is_furniture", "norm_word"]
