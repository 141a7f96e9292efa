"""Keyword matching of free text against the assistant's knowledge base.

Score of an entry for a text = sum over its distinct normalised keys of
  3 if the key is a phrase (has a space) and occurs in the text,
  2 else if the key is a whole word of the text,
  1 else if the key has >= 5 letters and occurs in the text (substring);
the best entry wins (first in base order on ties); below 2 means no match.

Every text is processed whole, in one projection without a shuffle. A key without
a space lies inside one word, so only the text's distinct words count for it: whole words
come from one intersection with the list of keys, and keys of five letters are searched
in the joined distinct words, if a single pattern (the keys as a prefix tree) finds any of
them there at all. Only phrases search the text. Points are added up per entry and the best
entry is the greatest of one struct per entry. All built-in expressions; no
UDF, no join, no explode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as TX

# ---------------------------------------------------------------------------
# Knowledge-base entries (id, match keys), in base order.
# ---------------------------------------------------------------------------
KNOWLEDGE_BASE = [
    ("cholesterol", ["cholesterol", "cholestérol", "hdl", "ldl", "lipides", "gras"]),
    ("hypertension", ["hypertension", "tension", "pression", "arterielle", "hta", "high bp"]),
    ("imc", ["imc", "indice", "masse", "corporelle", "poids", "bmi", "obesite", "surpoids"]),
    ("diabete", ["diabete", "diabète", "glycemie", "sucre", "prediabete", "insuline"]),
    ("tabac", ["tabac", "tabagisme", "fumer", "fumeur", "cigarette", "smoker", "nicotine"]),
    ("sante_percue", ["sante", "santé", "percue", "perçue", "generale", "genhlth", "etat"]),
    ("mal_etre", ["mal-etre", "mal etre", "jours", "mental", "physique", "menthlth", "physhlth", "moral"]),
    ("acces_soins", ["couverture", "assurance", "soins", "medecin", "renoncement", "cout", "acces", "assure"]),
    ("simulateur", ["simulateur", "et si", "scenario", "changement", "ameliorer", "what if"]),
    ("score", ["score", "pourcentage", "risque estime", "probabilite", "resultat", "chiffre", "signifie"]),
    ("niveau", ["niveau", "faible", "eleve", "élevé", "moyen", "couleur"]),
    ("positionnement", ["positionnement", "centile", "percentile", "pairs", "position", "comparaison", "moyenne"]),
    ("scoring_lot", ["lot", "batch", "csv", "fichier", "masse", "plusieurs", "importer"]),
    ("pdf", ["pdf", "telecharger", "bilan", "rapport", "imprimer", "document"]),
    ("tableau_bord", ["tableau", "bord", "dashboard", "population", "graphique", "tendance"]),
    ("diagnostic", ["diagnostic", "medical", "confiance", "vrai", "certain", "malade", "serieux"]),
    ("donnees", ["donnees", "données", "source", "brfss", "cdc", "origine", "provenance", "echantillon"]),
    ("fiabilite", ["fiabilite", "fiable", "performance", "precision", "auc", "qualite", "marche"]),
    ("reduire_risque", ["reduire", "réduire", "baisser", "ameliorer", "diminuer", "prevention", "conseils", "faire"]),
    ("profils", ["profils", "profil", "groupes", "clustering", "types", "categories", "population"]),
]
MIN_SCORE = 2


def normalised_keys() -> list[tuple[str, list[str]]]:
    """Distinct normalised keys per entry, in a stable order."""
    out = []
    for eid, keys in KNOWLEDGE_BASE:
        seen = []
        for k in keys:
            n = TX.normalise_py(k)
            if n not in seen:
                seen.append(n)
        out.append((eid, seen))
    return out


def prefix_pattern(keys: list[str]) -> str:
    """A regular expression that finds any of the keys, with common beginnings said once."""
    by: dict[str, list[str]] = {}
    for k in sorted(set(keys)):
        by.setdefault(k[0], []).append(k[1:])
    parts = [c + ("" if "" in rest else prefix_pattern(rest)) for c, rest in by.items()]
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


def _points(key: str) -> Column:
    """Points of one key, from the columns ``_norm``, ``_found`` (whole words), ``_words`` (all distinct ones, joined) and ``_any``."""
    if " " in key:
        return F.when(F.instr("_norm", key) > 0, 3).otherwise(0)
    whole = F.array_contains("_found", key)
    if len(key) < 5:
        return F.when(whole, 2).otherwise(0)
    return F.when(F.col("_any"), F.when(whole, 2).when(F.instr("_words", key) > 0, 1).otherwise(0)).otherwise(0)


def match(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """Best knowledge-base entry per row: (keep..., faq_id or null, best_score). A null text matches nothing."""
    base = normalised_keys()
    single = sorted({k for _, keys in base for k in keys if " " not in k})
    x = df.select(*keep, TX.normalise(text_col).alias("_norm"))
    x = x.select(*keep, "_norm", F.array_distinct(F.split("_norm", " ")).alias("_distinct"))
    x = x.select(*keep, "_norm", F.array_intersect("_distinct", F.lit(single)).alias("_found"), F.array_join("_distinct", " ").alias("_words"))
    x = x.select(*keep, "_norm", "_found", "_words", F.col("_words").rlike(prefix_pattern([k for k in single if len(k) >= 5])).alias("_any"))
    entries = [F.struct(F.coalesce(sum((_points(k) for k in keys), F.lit(0)), F.lit(0)).alias("score"), F.lit(-i).alias("neg_pos"),
                        F.lit(eid).alias("faq_id")) for i, (eid, keys) in enumerate(base)]
    best = x.select(*keep, F.greatest(*entries).alias("_b"))
    score = F.col("_b.score").cast("long")
    return best.select(*keep, F.when(score >= MIN_SCORE, F.col("_b.faq_id")).alias("faq_id"), score.alias("best_score"))


def match_sql(table: str, text_col: str, keep: list[str]) -> str:
    """DuckDB oracle: one row per (text, entry) score, best per text by (score desc, entry order)."""
    kp = ", ".join(keep)
    parts = []
    for i, (eid, keys) in enumerate(normalised_keys()):
        terms = []
        for k in keys:
            if " " in k:
                terms.append(f"CASE WHEN contains(nt, '{k}') THEN 3 ELSE 0 END")
            elif len(k) >= 5:
                terms.append(f"CASE WHEN list_contains(w, '{k}') THEN 2 WHEN contains(nt, '{k}') THEN 1 ELSE 0 END")
            else:
                terms.append(f"CASE WHEN list_contains(w, '{k}') THEN 2 ELSE 0 END")
        parts.append(f"SELECT {kp}, {i} AS pos, '{eid}' AS faq_id, {' + '.join(terms)} AS score FROM n")
    return (f"WITH n0 AS (SELECT {kp}, {TX.normalise_sql(text_col)} AS nt FROM {table}), "
            "n AS (SELECT *, string_split_regex(trim(nt), ' +') AS w FROM n0), "
            f"s AS ({' UNION ALL '.join(parts)}), "
            f"r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY {kp} ORDER BY score DESC, pos) AS rk FROM s) "
            f"SELECT {kp}, CASE WHEN score >= {MIN_SCORE} THEN faq_id END AS faq_id, CAST(score AS BIGINT) AS best_score FROM r WHERE rk = 1")
