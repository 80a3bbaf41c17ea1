"""DuckDB oracle SQL for the registered queries.

Independent, direct formulations over the driver's tables (views ``events``,
``documents``, ``embeddings``, ``labels`` ...): plain LAG over each video's
whole history, explicit median/MAD on lists, pair joins where the Spark side
uses a closed form. Doubles are rounded the same way on both sides.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


# Fixed values, written out here on their own: a wrong constant in the library must
# not pass by being wrong on both sides.
@dataclass(frozen=True)
class Params:
    window_seconds: int = 21600
    max_windows: int = 20
    warmup: int = 10
    min_history: int = 3
    noise_floor: float = 1.2
    dampen_factor: float = 0.1
    robotic_multiplier: float = 1.5
    robotic_threshold: float = -2.0
    mad_constant: float = 1.4826
    z_cap: float = 20.0
    score_decimals: int = 4
    mad_floors: dict = field(default_factory=lambda: {
        "count": 2.0, "author": 2.0, "length": 10.0, "sentiment": 0.1, "concentration": 0.15,
        "sentiment_var": 0.05, "gap": 5.0, "gap_var": 10.0})
    weights: dict = field(default_factory=lambda: {
        "concentration": 0.40, "gap_variance": 0.30, "sentiment_var": 0.20, "count": 0.10})
    volume_guard: int = 5
    timing_gap_var_z: float = -1.5
    sentiment_abs_z: float = 2.0
    sentiment_var_z: float = -1.0
    volume_count_z: float = 2.0
    volume_author_z: float = 1.0
    spam_concentration_z: float = 2.5
    similarity_sample: int = 50
    similarity_threshold: float = 0.40
    timeline_limit: int = 10
    spammer_limit: int = 5
    spammer_samples: int = 3
    top_keywords: int = 3
    keyword_max_df: float = 0.95
    author_display: int = 8
    sample_display: int = 70
    timeline_display: int = 80
    positive_label: str = "POSITIVE"

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


SIX_HOURS = Params()

PATTERN_MESSAGES = {
    "automated_timing": "Automated Timing: Inter-comment gaps show unnatural statistical consistency.",
    "coordinated_sentiment": "Coordinated Sentiment: A sudden, uniform shift in tone with unusually low variance.",
    "volume_anomaly": "Volume Anomaly: A massive comment spike generated by a disproportionately small number of authors.",
    "high_frequency_spam": "High-Frequency Spam: Individual accounts are posting multiple times within this window.",
}

# Default English stop words of Apache Spark (Apache License 2.0), in Spark's order.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom
this that these those am is are was were be been being have has had having do does did doing
a an the and but if or because as until while of at by for with about against between into
through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now i'll you'll
he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
how's let's ought that's there's what's when's where's who's why's would
"""

POSITIVE_WORDS = """good great love excellent amazing awesome best nice happy wonderful thanks
fantastic perfect beautiful like"""
NEGATIVE_WORDS = """bad terrible hate awful worst poor sad horrible boring angry wrong
disappointing ugly stupid fake"""

# White space of Unicode and the separators 0x1C to 0x1F.
BLANKS = (r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
          r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")


def _single(x: str) -> str:
    """The double ``x`` at single precision, as a double; below 1e-9 it is 0. Two
    engines add doubles in different orders, so their last bits differ; both sides
    of the check are shown at the precision that they share."""
    return f"(CASE WHEN abs({x}) < 1e-9 THEN CAST(0 AS DOUBLE) ELSE CAST(CAST({x} AS FLOAT) AS DOUBLE) END)"


def _dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def comments_cte(name: str = "c", where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT CAST(event_id AS VARCHAR) AS comment_id,
         event_type AS video_id,
         CAST(user_id AS VARCHAR) AS author_id,
         coalesce(props, '') AS text,
         greatest(CAST(-1.0 AS DOUBLE), least(CAST(1.0 AS DOUBLE), value / 100 - 1)) AS sentiment,
         CAST(epoch_us(ts) // 1000000 AS BIGINT) AS sec
  FROM events WHERE {where})"""


def gaps_cte(scope: str = "video", L: int = SIX_HOURS.window_seconds, src: str = "c",
             name: str = "g") -> str:
    part = "video_id" if scope == "video" else "video_id, sec - (sec % {L})".format(L=L)
    return f"""{name} AS (
  SELECT *, sec - lag(sec) OVER (PARTITION BY {part} ORDER BY sec, comment_id) AS gap,
         sec - (sec % {L}) AS w
  FROM {src})"""


def metrics_cte(name: str = "m", src: str = "g") -> str:
    return f"""{name} AS (
  SELECT video_id, w, make_timestamp(w * 1000000) AS window_start,
         count(*) AS total_comments,
         count(DISTINCT author_id) AS unique_authors,
         coalesce(avg(length(text)), 0) AS avg_length,
         coalesce(avg(sentiment), 0) AS avg_sentiment,
         greatest(CAST(0 AS DOUBLE), coalesce(avg(sentiment * sentiment) - avg(sentiment) * avg(sentiment), 0))
           AS sentiment_variance,
         CASE WHEN count(gap) > 0 THEN CAST(sum(gap) AS DOUBLE) / count(gap) ELSE 0 END AS avg_gap,
         CASE WHEN count(gap) > 0 THEN greatest(CAST(0 AS DOUBLE),
              CAST(sum(gap * gap) AS DOUBLE) / count(gap)
              - (CAST(sum(gap) AS DOUBLE) / count(gap)) * (CAST(sum(gap) AS DOUBLE) / count(gap)))
              ELSE 0 END AS gap_variance
  FROM {src} GROUP BY video_id, w)"""


MEASURE_COLS = ["total_comments", "unique_authors", "avg_length", "avg_sentiment",
                "sentiment_variance", "avg_gap", "gap_variance"]
Z_COLS = ["count_z", "author_z", "length_z", "sentiment_z", "concentration_z",
          "sentiment_var_z", "gap_z", "gap_var_z"]
# z column -> (current value, history value, floor key)
_SIG = {
    "count_z": ("CAST(total_comments AS DOUBLE)", "count"),
    "author_z": ("CAST(greatest(unique_authors, 1) AS DOUBLE)", "author"),
    "length_z": ("avg_length", "length"),
    "sentiment_z": ("avg_sentiment", "sentiment"),
    "concentration_z": ("CAST(total_comments AS DOUBLE) / greatest(unique_authors, 1)", "concentration"),
    "sentiment_var_z": ("sentiment_variance", "sentiment_var"),
    "gap_z": ("avg_gap", "gap"),
    "gap_var_z": ("gap_variance", "gap_var"),
}


def _z_expr(value: str, hist: str, floor: float, p: Params) -> str:
    med = f"list_median({hist})"
    mad = f"list_median(list_transform({hist}, lambda x: abs(x - {med})))"
    raw = f"({value} - {med}) / greatest({_dbl(p.mad_constant)} * {mad}, {_dbl(floor)})"
    return (f"CASE WHEN coalesce(len({hist}), 0) < {p.warmup} THEN NULL "
            f"WHEN len({hist}) < {p.min_history} THEN CAST(0 AS DOUBLE) "
            f"ELSE greatest({_dbl(-p.z_cap)}, least({_dbl(p.z_cap)}, {raw})) END")


def baseline_cte(p: Params = SIX_HOURS, src: str = "m", h: str = "h", b: str = "b") -> str:
    """Two CTEs: h (history lists) and b (z columns)."""
    lists = ",\n         ".join(
        f"list({v}) OVER wf AS h_{k}" for k, (v, _) in ((z, (_SIG[z][0], None)) for z in Z_COLS))
    zs = ",\n         ".join(
        _z_expr(_SIG[z][0], f"h_{z}", p.mad_floors[_SIG[z][1]], p) + f" AS {z}" for z in Z_COLS)
    return f"""{h} AS (
  SELECT *,
         {lists}
  FROM {src}
  WINDOW wf AS (PARTITION BY video_id ORDER BY w ROWS BETWEEN {p.max_windows} PRECEDING AND 1 PRECEDING)),
{b} AS (
  SELECT video_id, w, window_start, {', '.join(MEASURE_COLS)},
         {zs}
  FROM {h})"""


def _dampen(z: str, p: Params) -> str:
    return (f"(CASE WHEN abs({z}) > {_dbl(p.noise_floor)} THEN abs({z}) "
            f"ELSE abs({z}) * {_dbl(p.dampen_factor)} END)")


def score_expr(p: Params = SIX_HOURS) -> str:
    w = p.weights
    gap = (f"{_dampen('gap_var_z', p)} * (CASE WHEN gap_var_z < {_dbl(p.robotic_threshold)} "
           f"THEN {_dbl(p.robotic_multiplier)} ELSE CAST(1.0 AS DOUBLE) END)")
    raw = (f"{_dampen('concentration_z', p)} * {_dbl(w['concentration'])} + {gap} * {_dbl(w['gap_variance'])}"
           f" + {_dampen('sentiment_var_z', p)} * {_dbl(w['sentiment_var'])}"
           f" + {_dampen('count_z', p)} * {_dbl(w['count'])}")
    return f"round({raw}, {p.score_decimals})"


def scored_ctes(p: Params = SIX_HOURS, scope: str = "video", prefix: str = "",
                where: str = "TRUE") -> str:
    """CTEs {prefix}c, g, m, h, b, s: comments .. scored windows."""
    n = {k: prefix + k for k in "cgmhbs"}
    return ",\n".join([
        comments_cte(n["c"], where), gaps_cte(scope, p.window_seconds, n["c"], n["g"]),
        metrics_cte(n["m"], n["g"]), baseline_cte(p, n["m"], n["h"], n["b"]),
        f"{n['s']} AS (SELECT *, {score_expr(p)} AS coordination_score FROM {n['b']})"])


def _shown(cols):
    return ", ".join(f"{_single(c)} AS {c}" for c in cols)


DOUBLE_MEASURES = ["avg_length", "avg_sentiment", "sentiment_variance", "avg_gap", "gap_variance"]


def flags_sql(p: Params = SIX_HOURS) -> str:
    return (f"(gap_var_z < {_dbl(p.timing_gap_var_z)}) AS automated_timing, "
            f"(abs(sentiment_z) > {_dbl(p.sentiment_abs_z)} AND sentiment_var_z < {_dbl(p.sentiment_var_z)}) "
            f"AS coordinated_sentiment, "
            f"(count_z > {_dbl(p.volume_count_z)} AND author_z < {_dbl(p.volume_author_z)}) AS volume_anomaly, "
            f"(concentration_z > {_dbl(p.spam_concentration_z)}) AS high_frequency_spam")


def alerts_cte(p: Params = SIX_HOURS) -> str:
    return f"""f AS (
  SELECT *, {flags_sql(p)} FROM s
  WHERE total_comments >= {p.volume_guard} AND count_z IS NOT NULL),
a AS (
  SELECT * FROM f
  WHERE automated_timing OR coordinated_sentiment OR volume_anomaly OR high_frequency_spam)"""


def q_window_metrics(p: Params = SIX_HOURS) -> str:
    return f"""WITH {comments_cte()},
{gaps_cte('video', p.window_seconds)},
{metrics_cte()}
SELECT video_id, window_start, total_comments, unique_authors, {_shown(DOUBLE_MEASURES)}
FROM m"""


def q_window_metrics_live(p: Params = SIX_HOURS) -> str:
    return f"""WITH {comments_cte()},
{gaps_cte('window', p.window_seconds)},
{metrics_cte()}
SELECT video_id, window_start, total_comments, unique_authors, {_shown(DOUBLE_MEASURES)}
FROM m"""


def q_rolling_baseline(p: Params = SIX_HOURS) -> str:
    return f"""WITH {scored_ctes(p)}
SELECT video_id, window_start, total_comments, unique_authors, {_shown(DOUBLE_MEASURES)},
       {_shown(Z_COLS)}
FROM s"""


def q_coordination_score(p: Params = SIX_HOURS) -> str:
    return f"""WITH {scored_ctes(p)}
SELECT video_id, window_start, total_comments, {_shown(Z_COLS)}, coordination_score
FROM s"""


def q_replay(p: Params = SIX_HOURS) -> str:
    return f"""WITH {scored_ctes(p)}
SELECT video_id, window_start, total_comments, unique_authors, {_shown(DOUBLE_MEASURES)},
       coalesce(coordination_score, CAST(0 AS DOUBLE)) AS coordination_score
FROM s"""


def q_detect_patterns(p: Params = SIX_HOURS) -> str:
    return f"""WITH {scored_ctes(p)},
{alerts_cte(p)}
SELECT video_id, window_start, total_comments, coordination_score,
       automated_timing, coordinated_sentiment, volume_anomaly, high_frequency_spam
FROM a"""


def q_explode_alerts(p: Params = SIX_HOURS) -> str:
    return f"""WITH {scored_ctes(p)},
{alerts_cte(p)}
{_alert_rows(p)}"""


def _alert_rows(p: Params, message: bool = True) -> str:
    kind = f"CASE WHEN concentration_z > {_dbl(p.spam_concentration_z)} THEN 'repeat_authors' ELSE 'timeline' END"
    parts = [f"SELECT video_id, window_start, coordination_score, {_shown(Z_COLS)}, {kind} AS evidence_kind, "
             f"'{k}' AS pattern" + (f", '{v}' AS message" if message else "") + f" FROM a WHERE {k}"
             for k, v in PATTERN_MESSAGES.items()]
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------- evidence

def _alert_comments_ctes(p: Params = SIX_HOURS) -> str:
    L = p.window_seconds
    return f"""{scored_ctes(p)},
{alerts_cte(p)},
ak AS (SELECT DISTINCT video_id, w, concentration_z FROM a),
ac AS (SELECT c.*, c.sec - (c.sec % {L}) AS w, make_timestamp(c.sec * 1000000) AS published_at
       FROM c JOIN ak ON c.video_id = ak.video_id AND c.sec - (c.sec % {L}) = ak.w)"""


def q_alert_comments(p: Params = SIX_HOURS) -> str:
    return f"""WITH {_alert_comments_ctes(p)}
SELECT video_id, make_timestamp(w * 1000000) AS window_start, comment_id, author_id, text,
       published_at, {_single('sentiment')} AS sentiment
FROM ac"""


def _timeline_cte(p: Params, src: str = "ac") -> str:
    return f"""tl AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY video_id, w ORDER BY sec, comment_id) AS rank
    FROM {src}) WHERE rank <= {p.timeline_limit})"""


def q_window_timeline(p: Params = SIX_HOURS) -> str:
    return f"""WITH {_alert_comments_ctes(p)},
{_timeline_cte(p)}
SELECT video_id, make_timestamp(w * 1000000) AS window_start, rank, comment_id, published_at,
       author_id, text, substr(author_id, 1, {p.author_display}) AS author_short,
       substr(text, 1, {p.timeline_display}) AS text_short
FROM tl"""


def _repeat_ctes(p: Params, src: str = "ac") -> str:
    return f"""cnt AS (
  SELECT video_id, w, author_id, count(*) AS comment_count FROM {src}
  GROUP BY video_id, w, author_id HAVING count(*) > 1),
top AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY video_id, w
                                 ORDER BY comment_count DESC, author_id ASC NULLS LAST) AS rank
    FROM cnt) WHERE rank <= {p.spammer_limit}),
smp AS (
  SELECT * FROM (
    SELECT video_id, w, author_id, text,
           row_number() OVER (PARTITION BY video_id, w, author_id ORDER BY sec, comment_id) AS sn
    FROM {src}) WHERE sn <= {p.spammer_samples}),
ra AS (
  SELECT top.video_id, top.w, top.rank, top.author_id, top.comment_count, smp.sn, smp.text
  FROM top JOIN smp ON top.video_id = smp.video_id AND top.w = smp.w
                   AND top.author_id IS NOT DISTINCT FROM smp.author_id)"""


def q_repeat_authors(p: Params = SIX_HOURS) -> str:
    return f"""WITH {_alert_comments_ctes(p)},
{_repeat_ctes(p)}
SELECT video_id, make_timestamp(w * 1000000) AS window_start, rank, author_id, comment_count,
       string_agg(text, chr(30) ORDER BY sn) AS samples,
       substr(author_id, 1, {p.author_display}) AS author_short,
       string_agg(substr(text, 1, {p.sample_display}), chr(30) ORDER BY sn) AS samples_short
FROM ra GROUP BY video_id, w, rank, author_id, comment_count"""


def q_alert_evidence(p: Params = SIX_HOURS) -> str:
    spam = f"concentration_z > {_dbl(p.spam_concentration_z)}"
    return f"""WITH {_alert_comments_ctes(p)},
kinds AS (SELECT DISTINCT video_id, w, CASE WHEN {spam} THEN 'repeat_authors' ELSE 'timeline' END AS kind
          FROM ak),
acs AS (SELECT ac.* FROM ac JOIN kinds USING (video_id, w) WHERE kind = 'repeat_authors'),
act AS (SELECT ac.* FROM ac JOIN kinds USING (video_id, w) WHERE kind = 'timeline'),
{_repeat_ctes(p, 'acs')},
{_timeline_cte(p, 'act')}
SELECT video_id, make_timestamp(w * 1000000) AS window_start, 'repeat_authors' AS evidence_kind,
       rank, CAST(sn AS INTEGER) AS sample_no, author_id, comment_count,
       CAST(NULL AS TIMESTAMP) AS published_at, text
FROM ra
UNION ALL
SELECT video_id, make_timestamp(w * 1000000), 'timeline', rank, CAST(NULL AS INTEGER), author_id,
       CAST(NULL AS BIGINT), published_at, text
FROM tl"""


# ---------------------------------------------------------------- text

TOKEN_RE = r"[\p{L}\p{N}_]{2,}"


def _tokens_sql(text: str) -> str:
    return f"regexp_extract_all(lower(coalesce({text}, '')), '{TOKEN_RE}')"


def q_mean_pairwise_cosine() -> str:
    return """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pairs AS (SELECT a.label, list_cosine_similarity(a.v, b.v) AS cos
          FROM e a JOIN e b ON a.label = b.label AND a.vec_id < b.vec_id),
sizes AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
agg AS (SELECT label, sum(cos) AS s FROM pairs GROUP BY label)
SELECT label, n AS n_items,
       CASE WHEN n < 2 THEN CAST(0 AS DOUBLE) ELSE round(coalesce(s, 0) / (n * (n - 1) / 2), 4) END
         AS similarity
FROM sizes LEFT JOIN agg USING (label)"""


def _bow_pairs_sql(src: str, key: str, doc: str, text: str) -> str:
    """CTEs tk, tf, nrm, u, pr, sz over a relation ``src``; ``key`` is the group column."""
    return f"""tk AS (SELECT {key}, {doc} AS doc, unnest({_tokens_sql(text)}) AS term FROM {src}),
tf AS (SELECT {key}, doc, term, count(*) AS tf FROM tk GROUP BY ALL),
nrm AS (SELECT {key}, doc, sqrt(sum(tf * tf)) AS norm FROM tf GROUP BY ALL),
u AS (SELECT tf.{key}, tf.doc, term, tf / norm AS u FROM tf JOIN nrm USING ({key}, doc)),
pr AS (SELECT a.{key}, sum(a.u * b.u) AS s FROM u a JOIN u b
       ON a.{key} = b.{key} AND a.term = b.term AND a.doc < b.doc GROUP BY a.{key}),
sz AS (SELECT {key}, count(*) AS n FROM {src} GROUP BY ALL)"""


def _sim_select(key: str) -> str:
    return f"""SELECT {key}, n AS n_items,
       CASE WHEN n < 2 THEN CAST(0 AS DOUBLE) ELSE round(coalesce(s, 0) / (n * (n - 1) / 2), 4) END
         AS similarity
FROM sz LEFT JOIN pr USING ({key})"""


def q_text_similarity() -> str:
    return f"""WITH {_bow_pairs_sql('conversations', 'conv_id', 'turn', 'text')}
{_sim_select('conv_id')}"""


def _stop_list() -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS.split())


def _keyword_ctes(src: str, key: str, doc: str, text: str, p: Params = SIX_HOURS) -> str:
    return f"""ktk AS (SELECT {key}, {doc} AS doc, unnest({_tokens_sql(text)}) AS term FROM {src}),
ktf AS (SELECT {key}, doc, term, count(*) AS tf FROM ktk WHERE term NOT IN ({_stop_list()})
        GROUP BY ALL),
ksz AS (SELECT {key}, count(*) AS n FROM {src} GROUP BY ALL HAVING count(*) >= 2),
kdf AS (SELECT {key}, term, count(*) AS df FROM ktf GROUP BY ALL),
kvoc AS (SELECT kdf.{key}, term, ln((1 + n) / (1 + df)) + 1 AS idf FROM kdf JOIN ksz USING ({key})
         WHERE df <= {_dbl(p.keyword_max_df)} * n),
kw AS (SELECT ktf.{key}, doc, term, tf * idf AS w FROM ktf JOIN kvoc USING ({key}, term)),
knrm AS (SELECT {key}, doc, sqrt(sum(w * w)) AS norm FROM kw GROUP BY ALL),
ksc AS (SELECT kw.{key}, term, sum(w / norm) AS score FROM kw JOIN knrm USING ({key}, doc)
        GROUP BY ALL),
ktop AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY score DESC, term)
                        AS rank FROM ksc) WHERE rank <= {p.top_keywords})"""


def q_top_keywords(p: Params = SIX_HOURS) -> str:
    return f"""WITH {_keyword_ctes('documents', 'source', 'doc_id', 'text', p)}
SELECT source, rank, term, {_single('score')} AS score FROM ktop"""


def q_templated_windows(p: Params = SIX_HOURS) -> str:
    return f"""WITH {_alert_comments_ctes(p)},
docs AS (SELECT doc_id, coalesce(text, '') AS dtext FROM documents),
act AS (SELECT ac.*, coalesce(docs.dtext, '') AS dtext FROM ac LEFT JOIN docs
        ON docs.doc_id = CAST(ac.comment_id AS BIGINT) % (SELECT count(*) FROM documents)),
smpl AS (SELECT video_id || '|' || CAST(w AS VARCHAR) AS gk, video_id, w, comment_id, dtext FROM (
           SELECT *, row_number() OVER (PARTITION BY video_id, w ORDER BY sec, comment_id) AS rn
           FROM act) WHERE rn <= {p.similarity_sample}),
{_bow_pairs_sql('smpl', 'gk', 'comment_id', 'dtext')},
sim AS ({_sim_select('gk')}),
hot AS (SELECT smpl.* FROM smpl JOIN sim USING (gk) WHERE sim.similarity > {_dbl(p.similarity_threshold)}),
{_keyword_ctes('hot', 'gk', 'comment_id', 'dtext', p)},
kl AS (SELECT gk, string_agg(term, ',' ORDER BY rank) AS keywords FROM ktop GROUP BY gk),
gkeys AS (SELECT DISTINCT gk, video_id, w FROM smpl)
SELECT gkeys.video_id, make_timestamp(gkeys.w * 1000000) AS window_start, sim.n_items, sim.similarity,
       sim.similarity > {_dbl(p.similarity_threshold)} AS templated,
       CASE WHEN sim.similarity > {_dbl(p.similarity_threshold)} THEN coalesce(kl.keywords, '') END
         AS keywords
FROM sim JOIN gkeys USING (gk) LEFT JOIN kl USING (gk)"""


def q_alert_table(p: Params = SIX_HOURS) -> str:
    """Pattern rows joined with the templated check and the evidence kind."""
    tw = q_templated_windows(p)
    tw_body = tw[len("WITH "):] if tw.startswith("WITH ") else tw
    # reuse the templated-window CTEs, then add pattern rows and evidence kinds
    select_at = tw_body.rindex("\nSELECT gkeys.video_id")
    ctes, final = tw_body[:select_at], tw_body[select_at + 1:]
    return f"""WITH {ctes},
tw AS ({final}),
pat AS ({_alert_rows(p, message=False)})
SELECT pat.video_id, pat.window_start, pat.pattern, pat.coordination_score, {", ".join(f"pat.{z}" for z in Z_COLS)},
       tw.similarity, tw.keywords, pat.evidence_kind
FROM pat LEFT JOIN tw ON tw.video_id = pat.video_id AND tw.window_start = pat.window_start"""


# ---------------------------------------------------------------- sentiment

def q_sentiment_score(p: Params = SIX_HOURS) -> str:
    return f"""SELECT doc_id, label, score,
       ((CASE WHEN label = '{p.positive_label}' THEN score ELSE 1 - score END) - 0.5) * 2 AS sentiment
FROM (SELECT doc_id, CASE WHEN quality = 1 THEN 'POSITIVE' ELSE 'NEGATIVE' END AS label,
             0.5 + (doc_id % 50) / 100.0 AS score FROM labels)"""


def _lexicon_ctes(src: str, cols: str, p: Params = SIX_HOURS) -> str:
    """CTEs lt, ll over ``src``: lexicon label/score and the blank flag of ``text``."""
    pos = ", ".join(f"'{w}'" for w in POSITIVE_WORDS.split())
    neg = ", ".join(f"'{w}'" for w in NEGATIVE_WORDS.split())
    toks = _tokens_sql("text")
    return f"""lt AS (
  SELECT {cols},
         regexp_replace(coalesce(text, ''), '{BLANKS}+', '', 'g') = '' AS blank,
         len(list_filter({toks}, lambda x: x IN ({pos}))) AS pos,
         len(list_filter({toks}, lambda x: x IN ({neg}))) AS neg
  FROM {src}),
ll AS (SELECT {cols}, blank,
             CASE WHEN blank THEN NULL WHEN pos > neg THEN 'POSITIVE' WHEN neg > pos THEN 'NEGATIVE'
                  ELSE 'NEUTRAL' END AS label,
             CASE WHEN blank THEN NULL ELSE CAST(greatest(pos, neg) + 1 AS DOUBLE) / (pos + neg + 2) END
               AS score
      FROM lt)"""


def _lexicon_value(p: Params = SIX_HOURS) -> str:
    return ("(CASE WHEN blank THEN CAST(0 AS DOUBLE) "
            f"ELSE ((CASE WHEN label = '{p.positive_label}' THEN score ELSE 1 - score END) - 0.5) * 2 END)")


def _lexicon_sentiment(p: Params = SIX_HOURS) -> str:
    return f"{_single(_lexicon_value(p))} AS sentiment"


def q_with_sentiment(p: Params = SIX_HOURS) -> str:
    return f"""WITH {_lexicon_ctes('documents', 'doc_id, text', p)}
SELECT doc_id, label, {_single('score')} AS score,
       {_lexicon_sentiment(p)}
FROM ll"""


EMBEDDED_LETTERS = "aeinst"


def q_with_embedding() -> str:
    cols = ", ".join(f"CAST(length(t) - length(replace(t, '{c}', '')) AS DOUBLE) AS e{i}"
                     for i, c in enumerate(EMBEDDED_LETTERS))
    return f"SELECT conv_id, turn, {cols} FROM (SELECT conv_id, turn, lower(coalesce(text, '')) AS t FROM conversations)"


# ---------------------------------------------------------------- sources / tables

BETWEEN = ("2024-01-10 00:00:00", "2024-01-12 00:00:00")
SPLIT_OLD_BEFORE = "2024-01-20 00:00:00"   # existing table: comments before this
SPLIT_NEW_FROM = "2024-01-15 00:00:00"     # new batch: comments from this on
REFETCH = ("2024-01-18 00:00:00", "2024-01-19 00:00:00")  # fetched twice in the batch
QUIET_VIDEO = "quiet_video"


def q_with_gaps() -> str:
    return f"""WITH {comments_cte()}
SELECT comment_id, video_id, make_timestamp(sec * 1000000) AS published_at,
       sec - lag(sec) OVER (PARTITION BY video_id ORDER BY sec, comment_id) AS gap
FROM c"""


def q_window_metrics_between() -> str:
    lo, hi = BETWEEN
    return f"""WITH {comments_cte()},
gi AS (SELECT *, sec - lag(sec) OVER (PARTITION BY video_id ORDER BY sec, comment_id) AS gap,
              CAST(epoch(TIMESTAMP '{lo}') AS BIGINT) AS w
       FROM c WHERE sec BETWEEN epoch(TIMESTAMP '{lo}') AND epoch(TIMESTAMP '{hi}')),
{metrics_cte('mi', 'gi')},
vids AS (SELECT DISTINCT video_id FROM c UNION SELECT '{QUIET_VIDEO}')
SELECT vids.video_id, TIMESTAMP '{lo}' AS window_start,
       coalesce(total_comments, 0) AS total_comments, coalesce(unique_authors, 0) AS unique_authors,
       {", ".join(f"{_single(f'coalesce({x}, 0)')} AS {x}" for x in DOUBLE_MEASURES)}
FROM vids LEFT JOIN mi USING (video_id)"""


def q_parse_comments() -> str:
    return f"""WITH {comments_cte()}
SELECT comment_id, video_id, author_id, text, make_timestamp(sec * 1000000) AS published_at FROM c"""


def q_normalize_timestamp() -> str:
    return """SELECT event_id, CAST(event_id % 7 AS INTEGER) AS variant,
       CASE WHEN event_id % 7 = 3 THEN NULL WHEN event_id % 7 = 6 THEN date_trunc('day', ts)
            ELSE date_trunc('second', ts) END AS published_at
FROM events"""


def q_high_water_marks() -> str:
    return f"""WITH {comments_cte()}
SELECT video_id, comment_id AS mark_id, make_timestamp(sec * 1000000) AS mark_at FROM (
  SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY sec DESC, comment_id DESC) AS rn FROM c)
WHERE rn = 1"""


def q_delta_since() -> str:
    return f"""WITH {comments_cte()},
{comments_cte('old', f"ts < TIMESTAMP '{SPLIT_OLD_BEFORE}'")},
mk AS (SELECT video_id, comment_id AS mark_id, sec AS mark_sec FROM (
  SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY sec DESC, comment_id DESC) AS rn FROM old)
  WHERE rn = 1)
SELECT c.comment_id, c.video_id, make_timestamp(c.sec * 1000000) AS published_at
FROM c LEFT JOIN mk USING (video_id)
WHERE mk.mark_sec IS NULL OR c.sec > mk.mark_sec OR (c.sec = mk.mark_sec AND c.comment_id > mk.mark_id)"""


def q_append_ignore_duplicates() -> str:
    return f"""WITH {comments_cte()}
SELECT comment_id, video_id, author_id, text,
       {_single('sentiment')} AS sentiment,
       make_timestamp(sec * 1000000) AS published_at, make_timestamp(sec * 1000000) AS fetched_at
FROM c"""


def q_upsert_window_metrics(p: Params = SIX_HOURS) -> str:
    old = scored_ctes(p, prefix="o", where=f"ts < TIMESTAMP '{SPLIT_OLD_BEFORE}'")
    new = scored_ctes(p, prefix="n", where=f"ts >= TIMESTAMP '{SPLIT_NEW_FROM}'")
    cols = (f"video_id, window_start, total_comments, unique_authors, {_shown(DOUBLE_MEASURES)}, "
            f"coalesce(coordination_score, CAST(0 AS DOUBLE)) AS coordination_score")
    return f"""WITH {old},
{new}
SELECT {cols} FROM os WHERE NOT EXISTS (
  SELECT 1 FROM ns WHERE ns.video_id = os.video_id AND ns.w = os.w)
UNION ALL
SELECT {cols} FROM ns"""


STREAM_WATERMARK_SECONDS = 3600


def q_stream_replay(p: Params = SIX_HOURS) -> str:
    """Batch scored windows: a closed stream has emitted every one of them."""
    return f"""WITH {scored_ctes(p)}
SELECT video_id, window_start, total_comments, unique_authors, {_shown(DOUBLE_MEASURES)},
       coordination_score
FROM s"""


def q_stream_alerts(p: Params = SIX_HOURS) -> str:
    return f"""WITH {scored_ctes(p)},
{alerts_cte(p)}
{_alert_rows(p, message=False)}"""


def q_stream_window_metrics(p: Params = SIX_HOURS) -> str:
    """Live (window-scope gap) measures."""
    return q_window_metrics_live(p)


def q_robust_z(p: Params = SIX_HOURS) -> str:
    """Robust z of each window's volume against the previous <= max_windows
    windows, without the warm-up gate (0 below the minimum history)."""
    no_warmup = p.with_(warmup=0)
    z = _z_expr("CAST(total_comments AS DOUBLE)", "hc", p.mad_floors["count"], no_warmup)
    return f"""WITH {comments_cte()},
{gaps_cte('video', p.window_seconds)},
{metrics_cte()},
hz AS (SELECT *, coalesce(list(CAST(total_comments AS DOUBLE)) OVER (
                    PARTITION BY video_id ORDER BY w
                    ROWS BETWEEN {p.max_windows} PRECEDING AND 1 PRECEDING), []::DOUBLE[]) AS hc
       FROM m)
SELECT video_id, window_start, total_comments, CAST(len(hc) AS BIGINT) AS history_size,
       {_single(f'({z})')} AS count_z
FROM hz"""


INGEST_FETCHED_AT = "2024-02-01 00:00:00"


def q_ingest_comments(p: Params = SIX_HOURS) -> str:
    """Every event once in the stored table (a re-fetch adds nothing), with
    lexicon sentiment of its text and the first fetch time."""
    return f"""WITH {comments_cte()},
{_lexicon_ctes('c', 'comment_id, video_id, author_id, text, sec', p)}
SELECT comment_id, video_id, author_id, text, {_lexicon_sentiment(p)},
       make_timestamp(sec * 1000000) AS published_at, TIMESTAMP '{INGEST_FETCHED_AT}' AS fetched_at
FROM ll"""


SCAN_VIDEO = "click"


def q_read_comments() -> str:
    lo, hi = BETWEEN
    return f"""WITH {comments_cte(where=f"event_type = '{SCAN_VIDEO}'")}
SELECT comment_id, video_id, author_id, text,
       {_single('sentiment')} AS sentiment,
       make_timestamp(sec * 1000000) AS published_at
FROM c WHERE sec BETWEEN epoch(TIMESTAMP '{lo}') AND epoch(TIMESTAMP '{hi}')"""


def _lexicon_comments(p: Params = SIX_HOURS) -> str:
    """CTEs up to c: comments parsed from pages, whose sentiment is the lexicon's."""
    return f"""{comments_cte('c0')},
{_lexicon_ctes('c0', 'comment_id, video_id, author_id, text, sec', p)},
c AS (SELECT comment_id, video_id, author_id, text, {_lexicon_value(p)} AS sentiment, sec FROM ll)"""


def q_stream_pages_window_metrics(p: Params = SIX_HOURS) -> str:
    return f"""WITH {_lexicon_comments(p)},
{gaps_cte('window', p.window_seconds)},
{metrics_cte()}
SELECT video_id, window_start, total_comments, unique_authors, {_shown(DOUBLE_MEASURES)}
FROM m"""


def q_live_pipeline(p: Params = SIX_HOURS) -> str:
    """The full replay of comments parsed from pages."""
    return f"""WITH {_lexicon_comments(p)},
{gaps_cte('video', p.window_seconds)},
{metrics_cte()},
{baseline_cte(p)},
s AS (SELECT *, {score_expr(p)} AS coordination_score FROM b)
SELECT video_id, window_start, total_comments, unique_authors, {_shown(DOUBLE_MEASURES)},
       coalesce(coordination_score, CAST(0 AS DOUBLE)) AS coordination_score
FROM s"""


def q_quarantined_items() -> str:
    """Every event as a dirty item: by event_id % 5, a bad time, no id, a page that
    does not parse (one per event), or a good item. Equal rows are
    stored once."""
    return """SELECT event_type AS video_id, CAST(event_id AS VARCHAR) AS comment_id, CAST(user_id AS VARCHAR) AS author_id,
       coalesce(props, '') AS text, 'soon' AS published_raw, 'bad_published_at' AS reason
FROM events WHERE event_id % 5 = 1
UNION
SELECT event_type, NULL, CAST(user_id AS VARCHAR), coalesce(props, ''), '2024-01-01T00:00:00Z', 'missing_id'
FROM events WHERE event_id % 5 = 2
UNION
SELECT event_type, NULL, NULL, 'broken ' || event_id, NULL, 'bad_page' FROM events WHERE event_id % 5 = 3"""


HANDOFF_AT = "2024-01-15 03:00:00"   # inside a window: it is moved down to the edge
HANDOFF_EDGE = "2024-01-15 00:00:00"


def q_stream_handoff(p: Params = SIX_HOURS) -> str:
    """Batch scored windows over the whole history, from the edge of the hand-off on."""
    return f"""WITH {scored_ctes(p)}
SELECT video_id, window_start, total_comments, unique_authors, {_shown(DOUBLE_MEASURES)},
       coordination_score
FROM s WHERE w >= CAST(epoch(TIMESTAMP '{HANDOFF_EDGE}') AS BIGINT)"""


INTERVAL_HOURS, INTERVAL_EXTRA = 72, 17


def _intervals_cte() -> str:
    """One interval for each (video, hour) that has comments: 1 to 72 hours and 17 seconds."""
    return f"""iv AS (SELECT DISTINCT video_id || '-' || CAST(sec // 3600 AS VARCHAR) AS interval_id, video_id, sec // 3600 * 3600 AS lo,
       sec // 3600 * 3600 + 3600 * (1 + (sec // 3600) % {INTERVAL_HOURS}) + {INTERVAL_EXTRA} AS hi FROM c)"""


def q_interval_metrics() -> str:
    return f"""WITH {comments_cte()},
{_intervals_cte()},
x AS (SELECT c.author_id, c.text, c.sentiment, c.sec, iv.interval_id AS video_id, 0 AS w,
             c.sec - lag(c.sec) OVER (PARTITION BY iv.interval_id ORDER BY c.sec, c.comment_id) AS gap
      FROM c JOIN iv ON c.video_id = iv.video_id AND c.sec BETWEEN iv.lo AND iv.hi),
{metrics_cte('mx', 'x')}
SELECT iv.interval_id, iv.video_id, make_timestamp(iv.lo * 1000000) AS start_at, make_timestamp(iv.hi * 1000000) AS end_at,
       total_comments, unique_authors, {_shown(DOUBLE_MEASURES)}
FROM iv JOIN mx ON mx.video_id = iv.interval_id"""


def q_interval_timeline(p: Params = SIX_HOURS) -> str:
    return f"""WITH {comments_cte()},
{_intervals_cte()},
r AS (SELECT iv.interval_id, row_number() OVER (PARTITION BY iv.interval_id ORDER BY c.sec, c.comment_id) AS rank,
             c.video_id, c.comment_id, make_timestamp(c.sec * 1000000) AS published_at, c.author_id, c.text
      FROM c JOIN iv ON c.video_id = iv.video_id AND c.sec BETWEEN iv.lo AND iv.hi)
SELECT * FROM r WHERE rank <= {p.timeline_limit}"""


#: Rounds of the live queries end here; the history ends at the first.
RESTART_AT, RESTART_FROM = "2024-01-25 00:00:00", "2024-01-24 22:00:00"
POLLS_AT = ("2024-01-20 00:00:07", "2024-01-22 10:11:12", "2024-01-22 10:11:13", "2024-01-31 23:59:59")


def q_poll_windows(p: Params = SIX_HOURS) -> str:
    """Aligned windows of the history, then one closed interval for each poll; each is
    held against the windows of its video before it."""
    polls = ", ".join(f"({k}, CAST(epoch(TIMESTAMP '{a}') AS BIGINT), CAST(epoch(TIMESTAMP '{b}') AS BIGINT))"
                      for k, (a, b) in enumerate(zip(POLLS_AT, POLLS_AT[1:])))
    return f"""WITH {_lexicon_comments(p)},
old AS (SELECT * FROM c WHERE sec <= epoch(TIMESTAMP '{POLLS_AT[0]}')),
{gaps_cte('video', p.window_seconds, 'old', 'g')},
{metrics_cte('mh', 'g')},
polls(k, lo, hi) AS (VALUES {polls}),
gp AS (SELECT c.*, lo AS w, sec - lag(sec) OVER (PARTITION BY video_id, k ORDER BY sec, comment_id) AS gap
       FROM c JOIN polls ON sec BETWEEN lo AND hi),
{metrics_cte('mp', 'gp')},
m AS (SELECT *, FALSE AS live FROM mh UNION ALL SELECT *, TRUE FROM mp),
{baseline_cte(p)},
s AS (SELECT b.*, {score_expr(p)} AS coordination_score FROM b)
SELECT s.video_id, s.window_start, s.total_comments, s.unique_authors, {_shown([f"s.{x}" for x in DOUBLE_MEASURES]).replace(" AS s.", " AS ")},
       CASE WHEN m.live THEN coordination_score ELSE coalesce(coordination_score, CAST(0 AS DOUBLE)) END AS coordination_score
FROM s JOIN m ON s.video_id = m.video_id AND s.w = m.w"""


def q_indexed_inserts() -> str:
    return f"""WITH {comments_cte()}
SELECT comment_id, video_id, author_id, text, {_single('sentiment')} AS sentiment, make_timestamp(sec * 1000000) AS published_at FROM c"""


#: Rounds of landed pages: (from, until). Video click lacks a page of the second for good,
#: purchase lacks it until the end.
ROUNDS = (("2024-01-01 00:00:00", "2024-01-12 00:00:00"), ("2024-01-11 00:00:00", "2024-01-20 00:00:00"),
          ("2024-01-19 00:00:00", "2024-02-02 00:00:00"))
ROUND_PAGE_SIZE, HOLE_FOR_GOOD, HOLE_FOR_A_WHILE = 20, "click", "purchase"


def q_stream_rounds() -> str:
    """Each comment once; of the video with the hole only the round before it, which its
    mark stays at."""
    return f"""WITH {comments_cte()},
t AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY sec DESC, comment_id DESC) AS rn FROM c
      WHERE video_id <> '{HOLE_FOR_GOOD}' OR sec < epoch(TIMESTAMP '{ROUNDS[0][1]}'))
SELECT t.comment_id, t.video_id, t.author_id, t.text, make_timestamp(t.sec * 1000000) AS published_at, t.rn = 1 AS is_mark FROM t"""


#: Comments that come late: an hour of all videos, and two days of one.
LATE_HOUR, LATE_DAYS, LATE_VIDEO = ("2024-01-10 03:00:00", "2024-01-10 04:00:00"), ("2024-01-15 00:00:00", "2024-01-17 00:00:00"), "click"


def q_model_sentiment() -> str:
    """The stand-in model: POSITIVE if the text has an even number of characters; the score
    follows from that number."""
    blank = f"regexp_replace(coalesce(text, ''), '{BLANKS}+', '', 'g') = ''"
    v = "CASE WHEN length(text) % 2 = 0 THEN 0.5::DOUBLE + (length(text) % 50)::DOUBLE / 100 ELSE 1 - (0.5::DOUBLE + (length(text) % 50)::DOUBLE / 100) END"
    return f"""SELECT doc_id, {_single(f"CASE WHEN {blank} THEN 0::DOUBLE ELSE ({v} - 0.5) * 2 END")} AS sentiment FROM documents"""
