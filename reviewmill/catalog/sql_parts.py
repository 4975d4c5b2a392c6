"""SQL fragments shared by the comparison statements (DuckDB dialect)."""

from __future__ import annotations

WS = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"
NOT_WS = r"[^\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}]"
WORD_TOKEN = (
    r"[\p{L}\p{M}]+|\p{N}+|[^\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}\p{L}\p{M}\p{N}]+"
)
EMOJI = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F700}-\x{1F77F}"
    r"\x{1F780}-\x{1F7FF}\x{1F800}-\x{1F8FF}\x{1F900}-\x{1F9FF}\x{1FA00}-\x{1FA6F}"
    r"\x{1FA70}-\x{1FAFF}\x{2600}-\x{26FF}\x{2700}-\x{27BF}]"
)


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+$', '')"


def clean(x: str) -> str:
    no_emoji = f"regexp_replace({x}, '{EMOJI}+', '', 'g')"
    no_special = f"regexp_replace({no_emoji}, '[^\\p{{L}}\\p{{N}}_\\s\\x{{0B}}\\x{{1C}}-\\x{{1F}}\\x{{85}}\\p{{Z}}]', '', 'g')"
    return f"regexp_replace({no_special}, '\\p{{Nd}}+', '', 'g')"


def split_space(x: str) -> str:
    return f"string_split({x}, ' ')"


def split_whitespace(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{WS}+'), lambda t: t <> '')"


def sign(x: str) -> str:
    return (
        f"CASE WHEN {x} > 0 THEN 'Positive' WHEN {x} < 0 THEN 'Negative' "
        f"WHEN {x} = 0 THEN 'Neutral' END"
    )


def pct(part: str, whole: str, digits: int | None) -> str:
    value = f"CAST({part} AS DOUBLE) / NULLIF({whole}, 0) * 100"
    return value if digits is None else f"round_even({value}, {digits})"


def word_report(keys: list[str], k: int, digits: int | None) -> str:
    """Report over a CTE ``counts(keys, sentiment, word, n)``."""
    cols = ", ".join(keys)
    on = " AND ".join(f"t.{c} = w.{c}" for c in keys)

    def total(name: str) -> str:
        return f"coalesce(sum(n) FILTER (sentiment = '{name}'), 0)"

    def words(name: str) -> str:
        return (
            f"coalesce(string_agg(word, ', ' ORDER BY rk) FILTER (sentiment = '{name}'), '') "
            f"AS top_{name.lower()}"
        )

    return f"""
totals AS (
  SELECT {cols}, {total('Positive')} AS p, {total('Negative')} AS n, {total('Neutral')} AS u,
         coalesce(sum(n) FILTER (sentiment IS NOT NULL), 0) AS t
  FROM counts GROUP BY {cols}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {cols}, sentiment ORDER BY n DESC, word) AS rk
  FROM counts WHERE sentiment IS NOT NULL),
words AS (
  SELECT {cols}, {words('Positive')}, {words('Neutral')}, {words('Negative')}
  FROM ranked WHERE rk <= {k} GROUP BY {cols}),
report AS (
  SELECT {', '.join('t.' + c for c in keys)},
         {pct('p', 't', digits)} AS positive_pct, {pct('u', 't', digits)} AS neutral_pct,
         {pct('n', 't', digits)} AS negative_pct,
         coalesce(top_positive, '') AS top_positive, coalesce(top_neutral, '') AS top_neutral,
         coalesce(top_negative, '') AS top_negative
  FROM totals t LEFT JOIN words w ON {on})"""


def review_report(keys: list[str], k: int, digits: int, tie: str, pure: bool) -> str:
    """Report over a CTE ``toks(keys, review_id, word)`` with a null word for empty texts."""
    cols = ", ".join(keys)
    on = " AND ".join(f"t.{c} = w.{c}" for c in keys)
    first = "WHEN p + n + u = 0 THEN 'Neutral' " if tie == "neutral" else ""

    def words(name: str) -> str:
        return (
            f"coalesce(string_agg(word, ', ' ORDER BY rk) FILTER (sentiment = '{name}'), '') "
            f"AS top_{name.lower()}"
        )

    def listed(name: str) -> str:
        column = f"coalesce(top_{name.lower()}, '')"
        if not pure:
            return f"{column} AS top_{name.lower()}"
        others = [c for c in ("positive", "negative") if c != name.lower()]
        test = " OR ".join(f"{o}_pct = 100" for o in others)
        return f"CASE WHEN {test} THEN '' ELSE {column} END AS top_{name.lower()}"

    return f"""
scored AS (
  SELECT toks.*, {sign('polarity')} AS sentiment FROM toks LEFT JOIN lexicon USING (word)),
per_review AS (
  SELECT {cols}, review_id, count(*) FILTER (sentiment = 'Positive') AS p,
         count(*) FILTER (sentiment = 'Negative') AS n,
         count(*) FILTER (sentiment = 'Neutral') AS u
  FROM scored GROUP BY {cols}, review_id),
classes AS (
  SELECT {cols}, review_id, CASE {first}WHEN p >= n AND p >= u THEN 'Positive'
         WHEN n >= u THEN 'Negative' ELSE 'Neutral' END AS cls FROM per_review),
shares AS (
  SELECT {cols}, {pct("count(*) FILTER (cls = 'Positive')", 'count(*)', digits)} AS positive_pct,
         {pct("count(*) FILTER (cls = 'Neutral')", 'count(*)', digits)} AS neutral_pct,
         {pct("count(*) FILTER (cls = 'Negative')", 'count(*)', digits)} AS negative_pct
  FROM classes GROUP BY {cols}),
counts AS (
  SELECT {cols}, sentiment, word, count(*) AS n FROM scored WHERE sentiment IS NOT NULL
  GROUP BY {cols}, sentiment, word),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {cols}, sentiment ORDER BY n DESC, word) AS rk
  FROM counts),
words AS (
  SELECT {cols}, {words('Positive')}, {words('Neutral')}, {words('Negative')}
  FROM ranked WHERE rk <= {k} GROUP BY {cols})
SELECT {', '.join('t.' + c for c in keys)}, positive_pct, neutral_pct, negative_pct,
       {listed('Positive')}, {listed('Neutral')}, {listed('Negative')}
FROM shares t LEFT JOIN words w ON {on}"""


def tagged(source: str, keep: list[str], text: str, normal: str = "tok") -> str:
    """CTEs ``pieces`` and ``tagged(keep, token_no, surface, lemma, pos)``; needs ``dictionary``."""
    cols = ", ".join(keep)
    return f"""
pieces AS (
  SELECT {cols}, unnest(toks) AS tok, generate_subscripts(toks, 1) - 1 AS token_no
  FROM (SELECT {cols}, regexp_extract_all({text}, '{WORD_TOKEN}') AS toks FROM {source})),
surfaces AS (SELECT {cols}, token_no, {normal} AS surface FROM pieces),
tagged AS (
  SELECT {', '.join('s.' + c for c in keep)}, token_no, s.surface, coalesce(d.lemma, s.surface) AS lemma,
         coalesce(d.pos, CASE WHEN regexp_matches(s.surface, '^\\p{{N}}') THEN 'Number'
           WHEN regexp_matches(s.surface, '^[\\p{{L}}\\p{{M}}]') THEN 'Noun'
           ELSE 'Punctuation' END) AS pos
  FROM surfaces s LEFT JOIN dictionary d ON s.surface = d.surface)"""
