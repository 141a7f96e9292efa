"""Text normalisation and knowledge-base matching over the driver's text tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as TX
from ..operators import textmatch as TM
from ..sources.tables import table
from .common import Registry

R = Registry()
q = R.add


@q("tx_normalise", f"SELECT conv_id, turn, {TX.normalise_sql('text')} AS text_norm FROM conversations")
def tx_normalise(spark, sf):
    """Every conversation turn normalised (lowercase, no accents, [a-z0-9 ] only)."""
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", TX.normalise("text").alias("text_norm"))


@q("tx_match", TM.match_sql("conversations", "text", ["conv_id", "turn"]))
def tx_match(spark, sf):
    """Best knowledge-base entry for every conversation turn (also jn_faq_keys)."""
    return TM.match(table(spark, sf, "conversations"), "text", ["conv_id", "turn"])


@q("tx_match_documents", TM.match_sql("documents", "text", ["doc_id"]))
def tx_match_documents(spark, sf):
    """The same matching over whole documents (up to 20 000 words each)."""
    return TM.match(table(spark, sf, "documents"), "text", ["doc_id"])


@q("tx_match_summary", "WITH m AS (" + TM.match_sql("documents", "text", ["doc_id"]) + ") "
   "SELECT faq_id, CAST(COUNT(*) AS BIGINT) AS n_docs, AVG(l.quality) AS mean_quality, CAST(COUNT(l.doc_id) AS BIGINT) AS n_labelled "
   "FROM m LEFT JOIN labels l USING (doc_id) GROUP BY faq_id")
def tx_match_summary(spark, sf):
    """Documents per matched entry, with the label coverage and mean quality label of each group."""
    m = TM.match(table(spark, sf, "documents"), "text", ["doc_id"])
    lab = table(spark, sf, "labels").select("doc_id", "quality", F.col("doc_id").alias("_labelled"))
    j = m.join(lab, "doc_id", "left")
    return j.groupBy("faq_id").agg(F.count(F.lit(1)).alias("n_docs"), F.avg("quality").alias("mean_quality"),
                                   F.count("_labelled").alias("n_labelled"))
