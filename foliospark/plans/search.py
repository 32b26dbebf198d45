"""Queries of full-text search and concordance."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.operators import positions as P
from foliospark.operators import search as S
from foliospark.operators.postings import all_postings
from foliospark.plans.base import CASES, ERAS, TOKENS, cases, index

WORD, PHRASES, OTHER = "thing", ["of the", "tion*"], "and"
LABELS = [n for n, _ in ERAS] + ["unknown"]
WHOLE = r"(^|[^\p{L}\p{N}])"


def _match(phrase: str) -> str:
    words = "[^\\p{L}\\p{N}]+".join(phrase.rstrip("*").split())
    end = "" if phrase.endswith("*") else "($|[^\\p{L}\\p{N}])"
    return f"regexp_matches(strip_accents(norm_text), '{WHOLE}{words}{end}')"


ANY = " OR ".join(map(_match, PHRASES))
NEXT = "list_contains(list_transform(range(1, len(w)), lambda i: w[i] = 'of' AND w[i + 1] = 'the'), true)"


def hits(spark, d, *phrases):
    return P.matching_ids(spark, index(spark, d), P.any_of([*phrases]))


def flagship(spark, d):
    return S.concordance(cases(spark, d), hits(spark, d, *PHRASES))


NEARS = P.Any((P.Near(P.Phrase("of the"), P.Phrase("with"), 5), P.Near(P.Phrase("and"), P.Phrase("tion*"), 1), P.Without(P.All((P.Phrase("in the"), P.Phrase("th*"))), P.Phrase("of"))))

QUERIES = {
    "c7_c9_concordance": (
        flagship,
        f"""WITH {CASES} SELECT era, jurisdiction, count(*) AS docs, count(*) FILTER (WHERE {ANY}) AS matches,
        round(1000 * count(*) FILTER (WHERE {ANY}) / count(*)::DOUBLE, 3) AS rate FROM cases GROUP BY era, jurisdiction""",
    ),
    "c1_postings": (
        lambda s, d: all_postings(s, index(s, d)).groupBy("token").agg({"*": "count", "pos": "sum"}).withColumnRenamed("count(1)", "n").withColumnRenamed("sum(pos)", "places"),
        f"""WITH {CASES}, {TOKENS}, p AS (SELECT unnest(w) AS token, generate_subscripts(w, 1) - 1 AS pos FROM tok)
        SELECT token, count(*) AS n, sum(pos)::BIGINT AS places FROM p GROUP BY token""",
    ),
    "c1_stemmed_matches": (lambda s, d: P.matching_ids(s, index(s, d), P.All((P.Phrase("the", stem=True), P.Phrase("and", stem=True)))), None),
    "c3_phrase_match": (
        lambda s, d: hits(s, d, "of the", "with*"),
        f"WITH {CASES} SELECT case_id FROM cases WHERE {_match('of the')} OR {_match('with*')}",
    ),
    "c3_phrase_spans": (
        lambda s, d: P.phrase_spans(s, index(s, d), P.Phrase("of the")),
        f"""WITH {CASES}, {TOKENS}, p AS (SELECT case_id, w, unnest(range(0, len(w) - 1)) AS first FROM tok)
        SELECT case_id, first, first + 1 AS last FROM p WHERE w[first + 1] = 'of' AND w[first + 2] = 'the'""",
    ),
    "c4_near": (
        lambda s, d: P.matching_ids(s, index(s, d), P.Near(P.Phrase("of the"), P.Phrase("with"), 5)),
        f"""WITH {CASES}, {TOKENS}, p AS (SELECT case_id, w, unnest(range(0, len(w))) AS i FROM tok),
        a AS (SELECT case_id, i AS f, i + 1 AS l FROM p WHERE w[i + 1] = 'of' AND w[i + 2] = 'the'), b AS (SELECT case_id, i FROM p WHERE w[i + 1] = 'with')
        SELECT DISTINCT a.case_id FROM a JOIN b ON a.case_id = b.case_id AND (b.i - a.l - 1 BETWEEN 0 AND 5 OR a.f - b.i - 1 BETWEEN 0 AND 5)""",
    ),
    "c4_any_of_nears": (
        lambda s, d: P.matching_ids(s, index(s, d), NEARS),
        f"""WITH {CASES}, {TOKENS}, p AS (SELECT case_id, w, unnest(range(0, len(w))) AS i FROM tok),
        a AS (SELECT case_id, i AS f, i + 1 AS l FROM p WHERE w[i + 1] = 'of' AND w[i + 2] = 'the'), b AS (SELECT case_id, i FROM p WHERE w[i + 1] = 'with'),
        c AS (SELECT case_id, i FROM p WHERE w[i + 1] = 'and'), e AS (SELECT case_id, i FROM p WHERE w[i + 1] LIKE 'tion%'),
        x AS (SELECT case_id FROM p WHERE w[i + 1] = 'in' AND w[i + 2] = 'the'), y AS (SELECT case_id FROM p WHERE w[i + 1] LIKE 'th%'), z AS (SELECT case_id FROM p WHERE w[i + 1] = 'of')
        SELECT a.case_id FROM a JOIN b ON a.case_id = b.case_id AND (b.i - a.l - 1 BETWEEN 0 AND 5 OR a.f - b.i - 1 BETWEEN 0 AND 5)
        UNION SELECT c.case_id FROM c JOIN e ON c.case_id = e.case_id AND abs(c.i - e.i) - 1 BETWEEN 0 AND 1
        UNION SELECT case_id FROM tok WHERE case_id IN (FROM x) AND case_id IN (FROM y) AND case_id NOT IN (FROM z)""",
    ),
    "c3_raw_spans": (
        lambda s, d: P.character_spans(cases(s, d), P.phrase_spans(s, index(s, d), P.Phrase("in the"))).join(cases(s, d).select("case_id", "raw_text"), "case_id").select("case_id", "first", F.lower(F.regexp_replace(F.expr("substr(raw_text, start + 1, end - start)"), r"\W+", " ")).alias("found")),
        f"WITH {CASES}, {TOKENS}, p AS (SELECT case_id, w, unnest(range(0, len(w) - 1)) AS first FROM tok) SELECT case_id, first, 'in the' AS found FROM p WHERE w[first + 1] = 'in' AND w[first + 2] = 'the'",
    ),
    "c5_phrase_evidence": (
        lambda s, d: S.phrase_evidence(cases(s, d).join(hits(s, d, "of the", "with"), "case_id", "left_semi"), ["of the", "with"]),
        f"""WITH {CASES}, m AS (SELECT *, strpos(norm_text, 'of the') AS a, strpos(norm_text, 'with') AS b FROM cases WHERE {_match("of the")} OR {_match("with")}),
        x AS (SELECT *, CASE WHEN a > 0 THEN a ELSE b END AS i, CASE WHEN a > 0 THEN 6 ELSE 4 END AS n FROM m)
        SELECT case_id, CASE WHEN i > 0 THEN i - 1 ELSE 0 END AS span_start, CASE WHEN i > 0 THEN i - 1 + n ELSE 0 END AS span_end,
        CASE WHEN i > 0 THEN substr(norm_text, greatest(i - 200, 1), i + n + 200 - greatest(i - 200, 1)) ELSE substr(norm_text, 1, 400) END AS matched_text FROM x""",
    ),
    "c6_regex_hits": (
        lambda s, d: S.regex_hits(cases(s, d), "th[aeiou]n+ing"),
        f"""WITH {CASES}, m AS (SELECT *, regexp_extract(norm_text, '(?i)th[aeiou]n+ing') AS x FROM cases WHERE regexp_matches(norm_text, '(?i)th[aeiou]n+ing')),
        p AS (SELECT *, strpos(norm_text, x) AS i FROM m)
        SELECT case_id, i - 1 AS span_start, i - 1 + length(x) AS span_end, substr(norm_text, greatest(i - 200, 1), i + length(x) + 200 - greatest(i - 200, 1)) AS matched_text FROM p""",
    ),
    "c8_cell_denominators": (lambda s, d: S.cell_counts(cases(s, d)), f"WITH {CASES} SELECT era, jurisdiction, count(*) AS n FROM cases GROUP BY era, jurisdiction"),
    "c10_era_table": (
        lambda s, d: S.era_table(flagship(s, d), [*LABELS, "never"]),
        f"""WITH {CASES}, e AS (SELECT unnest(range({len(LABELS) + 1})) AS era_order, unnest({[*LABELS, "never"]}) AS era),
        x AS (SELECT era, count(*) AS docs, count(*) FILTER (WHERE {ANY}) AS matches FROM cases GROUP BY era)
        SELECT era_order, e.era, coalesce(docs, 0) AS docs, coalesce(matches, 0) AS matches, CASE WHEN docs > 0 THEN round(1000 * matches / docs::DOUBLE, 3) END AS rate FROM e LEFT JOIN x ON e.era = x.era""",
    ),
    "c11_earliest": (
        lambda s, d: S.earliest(cases(s, d), ["of the"], 25),
        f"""WITH {CASES}, m AS (SELECT *, regexp_extract(norm_text, '{WHOLE}(of[^\\p{{L}}\\p{{N}}]+the)($|[^\\p{{L}}\\p{{N}}])', 2) AS x FROM cases WHERE year IS NOT NULL AND {_match("of the")} ORDER BY year, case_id LIMIT 25),
        p AS (SELECT *, length(regexp_extract(norm_text, '^(.*?){WHOLE}of[^\\p{{L}}\\p{{N}}]+the($|[^\\p{{L}}\\p{{N}}])', 1)) AS b, regexp_extract(norm_text, '^(.*?){WHOLE}of[^\\p{{L}}\\p{{N}}]+the($|[^\\p{{L}}\\p{{N}}])', 2) AS c FROM m),
        q AS (SELECT *, b + length(c) + 1 AS i FROM p)
        SELECT case_id, year, jurisdiction, substr(norm_text, greatest(i - 40, 1), i - greatest(i - 40, 1)) || '[' || x || ']' || substr(norm_text, i + length(x), 40) AS snippet FROM q""",
    ),
    "c12_kwic": (
        lambda s, d: S.kwic(cases(s, d), "tion", 50),
        f"""WITH {CASES}, m AS (SELECT *, strpos(norm_text, 'tion') AS i FROM cases WHERE contains(norm_text, 'tion') ORDER BY case_id LIMIT 50)
        SELECT case_id, substr(norm_text, greatest(i - 60, 1), i - greatest(i - 60, 1)) AS "left", 'tion' AS term, substr(norm_text, i + 4, 60) AS "right" FROM m""",
    ),
    "c13_collocates": (
        lambda s, d: S.collocates(cases(s, d), "with", 40),
        f"""WITH {CASES}, s AS (SELECT norm_text, string_split(norm_text, 'with') AS p FROM cases WHERE contains(norm_text, 'with')),
        o AS (SELECT norm_text, p, unnest(range(1, len(p))) AS k FROM s),
        i AS (SELECT norm_text, list_sum(list_transform(p[1:k], lambda y: length(y))) + 4 * (k - 1) + 1 AS i FROM o),
        w AS (SELECT unnest(regexp_extract_all(substr(norm_text, greatest(i - 80, 1)::BIGINT, (i + 84 - greatest(i - 80, 1))::BIGINT), '[a-z]+')) AS word FROM i)
        SELECT word, count(*) AS n FROM w WHERE length(word) > 2 AND word <> 'with' AND word NOT IN ({", ".join(repr(x) for x in S.STOPWORDS)}) GROUP BY word ORDER BY n DESC, word LIMIT 40""",
    ),
    "c14_frequency_pivot": (
        lambda s, d: S.frequency_pivot(cases(s, d), hits(s, d, *PHRASES), LABELS),
        f"WITH {CASES} SELECT jurisdiction, " + ", ".join(f"count(*) FILTER (WHERE era = '{e}') AS \"{e}\"" for e in LABELS) + f" FROM cases WHERE {ANY} GROUP BY jurisdiction",
    ),
}
