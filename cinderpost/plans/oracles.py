"""The same results as plain SQL over the base tables, one statement per query.

Each statement carries the views it needs as common table expressions. Constants (patterns,
stop words) are shared with the library; the logic is written anew.
"""

from __future__ import annotations

import re

from cinderpost.functions import patterns as P
from cinderpost.plans import oracles_stem


def _q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_STOPS = ", ".join(_q(word) for word in P.STOP_WORDS)


def _strip(column: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({column}, {_q(pattern)}, {_q(by)}, 'g')"


def _lower_capitalized(column: str) -> str:
    gaps = f"regexp_split_to_array({column}, {_q(P.CAPITALIZED)})"
    words = f"regexp_extract_all({column}, {_q(P.CAPITALIZED)})"
    return (
        f"array_to_string(list_transform(list_zip({gaps}, {words}), "
        "lambda pair: pair[1] || coalesce(lower(pair[2]), '')), '')"
    )


def _contracted(column: str) -> str:
    for ending in P.CONTRACTIONS:
        column = f"regexp_replace({column}, {_q(ending)}, '\\1' || chr(10) || '\\2', 'g')"
    return column


_VIEWS = {
    "posts": """
        SELECT d.doc_id AS id,
          CASE WHEN d.doc_id % 7 = 0 THEN NULL ELSE d.source END AS keyword,
          CASE WHEN d.doc_id % 3 = 0 THEN NULL ELSE d.lang END AS location,
          d.text || coalesce(' ' || p.url, '') || ' I don''t &amp; 2024 #' || d.source
            || ' @user' AS text,
          l.quality AS target,
          CASE WHEN d.doc_id % 10 < 7 THEN 'train' ELSE 'test' END AS split
        FROM documents d
        LEFT JOIN pages p ON p.page_id = d.doc_id
        LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "gold": """
        SELECT d.doc_id AS seq, concat('* ', d.text, ' !') AS text,
          CASE WHEN l.toxic = 1 THEN 'Can''t Decide'
               WHEN d.doc_id % 2 = 0 THEN 'Relevant' ELSE 'Not Relevant' END AS choose_one
        FROM documents d JOIN labels l ON l.doc_id = d.doc_id""",
    "history": """
        SELECT user_id AS run_id,
          row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS epoch,
          value AS test_acc
        FROM events""",
    "preds": """
        SELECT d.doc_id AS id, CASE WHEN d.n_chars > 500 THEN 1 ELSE 0 END AS pred,
          l.quality AS target
        FROM documents d JOIN labels l ON l.doc_id = d.doc_id""",
    "clean1": f"""SELECT * REPLACE (
          {_strip(_strip(_strip("text", P.URL), P.ENTITY), P.NUMBER, " ")} AS text) FROM posts""",
    "clean2": f"SELECT * REPLACE ({_lower_capitalized('text')} AS text) FROM clean1",
    "cleaned": f"SELECT * REPLACE ({_strip('text', P.TAG)} AS text) FROM clean2",
    "pieces": f"""SELECT *, list_filter(regexp_split_to_array(text, {_q(P.BLANKS)}),
          lambda x: x <> '') AS pieces FROM cleaned""",
    "kept": f"""SELECT * EXCLUDE (pieces), list_filter(pieces,
          lambda x: lower(x) NOT IN ({_STOPS})) AS pieces FROM pieces""",
    "raw_tokens": f"""SELECT *, regexp_extract_all(array_to_string(pieces, ' '),
          {_q(P.TOKEN)}) AS raw FROM kept""",
    "tokens": f"""SELECT id, keyword, location, target, split, list_filter(string_split(
          {_contracted("array_to_string(raw, chr(10))")}, chr(10)), lambda x: x <> '') AS tokens
        FROM raw_tokens""",
    "words": "SELECT id, split, target, unnest(tokens) AS term FROM tokens",
    "tf": """SELECT id, split, target, term, count(*)::INTEGER AS tf FROM words
        GROUP BY id, split, target, term""",
    "train_docs": "SELECT count(*) AS n FROM tokens WHERE split = 'train'",
    "train_df": "SELECT term, count(*) AS df FROM tf WHERE split = 'train' GROUP BY term",
    "train_idf": """SELECT term, df, log10((SELECT n FROM train_docs)) - log10(df) AS idf
        FROM train_df""",
    "joint": """SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id
        FROM (SELECT DISTINCT term FROM words)
        UNION ALL SELECT '<pad>', count(DISTINCT term) FROM words""",
    "train_keywords": "SELECT DISTINCT keyword FROM posts WHERE split = 'train'",
    "keyword_ids": """SELECT keyword, row_number() OVER (ORDER BY keyword NULLS FIRST) - 1 AS keywd
        FROM train_keywords""",
    "meta": f"""SELECT id, split, target, 'loc' AS feature, 1.0::DOUBLE AS value
          FROM posts WHERE location IS NOT NULL
        UNION ALL SELECT id, split, target, 'url',
            len(regexp_extract_all(text, {_q(P.URL)}))::DOUBLE FROM posts
          WHERE len(regexp_extract_all(text, {_q(P.URL)})) > 0
        UNION ALL SELECT id, split, target, coalesce('kw:' || keyword, 'kw'), 1.0::DOUBLE
          FROM posts""",
    # naive Bayes over labelled posts, long form, three weightings
    "ltf": "SELECT * FROM tf WHERE target IS NOT NULL",
    "ldocs": "SELECT count(*) AS n FROM tokens WHERE target IS NOT NULL AND split = 'train'",
    "lidf": """SELECT term, log10((SELECT n FROM ldocs)) - log10(count(*)) AS idf FROM ltf
        WHERE split = 'train' GROUP BY term""",
    "lrows": """SELECT weighting, id, split, target, 'w:' || term AS feature,
          CASE weighting WHEN 'Frequency' THEN tf::DOUBLE WHEN 'Binary' THEN 1.0::DOUBLE
            ELSE (1 + log10(tf)) * idf END AS value
        FROM ltf JOIN lidf USING (term)
          CROSS JOIN (VALUES ('Frequency'), ('Binary'), ('TFIDF')) w(weighting)
        UNION ALL SELECT weighting, id, split, target, feature, value FROM meta
          CROSS JOIN (VALUES ('Frequency'), ('Binary'), ('TFIDF')) w(weighting)
        WHERE target IS NOT NULL""",
    "lcolumns": """SELECT 'w:' || term AS feature FROM lidf
        UNION SELECT 'loc' UNION SELECT 'url'
        UNION SELECT coalesce('kw:' || keyword, 'kw') FROM posts
          WHERE target IS NOT NULL AND split = 'train'""",
    "lsums": """SELECT w.weighting, c.feature,
          coalesce(sum(value) FILTER (target = 0), 0) AS s0,
          coalesce(sum(value) FILTER (target = 1), 0) AS s1
        FROM lcolumns c CROSS JOIN (VALUES ('Frequency'), ('Binary'), ('TFIDF')) w(weighting)
          LEFT JOIN lrows r
            ON r.feature = c.feature AND r.weighting = w.weighting AND r.split = 'train'
        GROUP BY w.weighting, c.feature""",
    "ltotals": """SELECT weighting, sum(s0) + count(*) AS t0, sum(s1) + count(*) AS t1
        FROM lsums GROUP BY weighting""",
    "lik": """SELECT weighting, feature, ln((s0 + 1) / t0) AS ll0, ln((s1 + 1) / t1) AS ll1
        FROM lsums JOIN ltotals USING (weighting)""",
    "prior": """SELECT target AS label, ln(count(*) / (SELECT n FROM ldocs)) AS log_prior
        FROM tokens WHERE target IS NOT NULL AND split = 'train' GROUP BY target""",
    "scores": """SELECT w.weighting, t.id, t.target,
          (SELECT log_prior FROM prior WHERE label = 0) + coalesce(sum(ll0 * value), 0) AS score0,
          (SELECT log_prior FROM prior WHERE label = 1) + coalesce(sum(ll1 * value), 0) AS score1
        FROM (SELECT id, target FROM tokens WHERE target IS NOT NULL AND split = 'test') t
          CROSS JOIN (VALUES ('Frequency'), ('Binary'), ('TFIDF')) w(weighting)
          LEFT JOIN (SELECT r.weighting, r.id, r.value, m.ll0, m.ll1 FROM lrows r JOIN lik m
                       ON m.feature = r.feature AND m.weighting = r.weighting) x
            ON x.id = t.id AND x.weighting = w.weighting
        GROUP BY w.weighting, t.id, t.target""",
    "nb_preds": """SELECT weighting, id, target, CASE WHEN score1 > score0 THEN 1 ELSE 0 END AS pred
        FROM scores""",
    # fixed linear weights
    "fixed": """SELECT t.id, t.target, t.split,
          1 / (1 + exp(-coalesce(sum((length(f.term) - 5) / 8192e0), 0))) AS p
        FROM (SELECT id, target, split FROM tokens WHERE target IS NOT NULL) t
          LEFT JOIN ltf f ON f.id = t.id
        GROUP BY t.id, t.target, t.split""",
    "slopes": """SELECT id, 2 * (p - target) * p * (1 - p) AS slope FROM fixed""",
    # every post, with or without a label
    "scores_all": """SELECT t.id,
          (SELECT log_prior FROM prior WHERE label = 0) + coalesce(sum(ll0 * value), 0) AS score0,
          (SELECT log_prior FROM prior WHERE label = 1) + coalesce(sum(ll1 * value), 0) AS score1
        FROM tokens t LEFT JOIN (
          SELECT r.id, r.value, m.ll0, m.ll1 FROM (
            SELECT id, 'w:' || term AS feature, tf::DOUBLE AS value FROM tf
            UNION ALL SELECT id, feature, value FROM meta) r
          JOIN lik m ON m.feature = r.feature AND m.weighting = 'Frequency') x ON x.id = t.id
        GROUP BY t.id""",
    "fixed_all": """SELECT t.id, t.target,
          1 / (1 + exp(-coalesce(sum((length(f.term) - 5) / 8192e0), 0))) AS p
        FROM tokens t LEFT JOIN tf f ON f.id = t.id GROUP BY t.id, t.target""",
    # label recovery
    "gold_keys": f"""SELECT sha256({_strip("text", P.NOT_ALNUM)}) AS key, seq,
          CASE choose_one WHEN 'Relevant' THEN 1 ELSE 0 END AS label
        FROM gold WHERE choose_one IN ('Relevant', 'Not Relevant')""",
    "matched": f"""SELECT d.doc_id AS id, coalesce(arg_max(g.label, g.seq), -1) AS target
        FROM documents d LEFT JOIN gold_keys g
          ON g.key = sha256({_strip("d.text", P.NOT_ALNUM)})
        GROUP BY d.doc_id""",
}

# full-batch descent, three steps of rate 1
_VIEWS["descent_rows"] = """SELECT id, target, 'w:' || term AS feature FROM ltf
    UNION ALL SELECT id, target, '1' FROM tokens WHERE target IS NOT NULL"""
_VIEWS["descent0"] = """SELECT DISTINCT feature, CASE WHEN feature = '1' THEN 0
    ELSE (length(feature) - 7) / 8192e0 END AS w FROM descent_rows"""
for _step in range(3):
    _VIEWS[f"descent{_step}p"] = f"""SELECT id, target, 1 / (1 + exp(-sum(w))) AS p
        FROM descent_rows JOIN descent{_step} USING (feature) GROUP BY id, target"""
    _VIEWS[f"descent{_step + 1}"] = f"""
        SELECT feature, any_value(w) - sum(2 * (p - r.target) * p * (1 - p))
          / (SELECT count(*) FROM descent{_step}p) AS w
        FROM descent_rows r JOIN descent{_step}p USING (id) JOIN descent{_step} USING (feature)
        GROUP BY feature"""

# two steps of rate 1 of a network of two hidden units
_VIEWS["net0"] = """SELECT DISTINCT feature, CASE WHEN feature = '1' THEN 0
    ELSE (length(feature) - 7) / 8192e0 END AS a, CASE WHEN feature = '1' THEN 0
    ELSE (length(feature) - 7) / -16384e0 END AS b FROM descent_rows"""
_VIEWS["out0"] = "SELECT 0.5e0 AS oa, -0.25e0 AS ob, 0.125e0 AS oc"
for _step in range(2):
    _VIEWS[f"net{_step}p"] = f"""SELECT id, target, u, v, p, 2 * (p - target) * p * (1 - p) AS slope
        FROM (SELECT id, target, u, v, 1 / (1 + exp(-(oa * u + ob * v + oc))) AS p
              FROM (SELECT id, target, 1 / (1 + exp(-sum(a))) AS u, 1 / (1 + exp(-sum(b))) AS v
                    FROM descent_rows JOIN net{_step} USING (feature) GROUP BY id, target)
                CROSS JOIN out{_step})"""
    _VIEWS[f"net{_step + 1}"] = f"""
        SELECT feature, any_value(a) - sum(slope * oa * u * (1 - u)) / any_value(n) AS a,
          any_value(b) - sum(slope * ob * v * (1 - v)) / any_value(n) AS b
        FROM descent_rows JOIN net{_step}p USING (id) JOIN net{_step} USING (feature)
          CROSS JOIN out{_step} CROSS JOIN (SELECT count(*) AS n FROM net{_step}p)
        GROUP BY feature"""
    _VIEWS[f"out{_step + 1}"] = f"""
        SELECT any_value(oa) - avg(slope * u) AS oa, any_value(ob) - avg(slope * v) AS ob,
          any_value(oc) - avg(slope) AS oc
        FROM net{_step}p CROSS JOIN out{_step}"""

# two epochs of four shuffled batches, a step of rate 1 for each
_VIEWS["batch_places"] = """SELECT id, (row_number() OVER (ORDER BY md5('7|' || id), id) - 1)
      // ((count(*) OVER () + 3) // 4) AS batch
    FROM tokens WHERE target IS NOT NULL"""
_VIEWS["batch0w"] = _VIEWS["descent0"]
for _step in range(8):
    _VIEWS[f"batch{_step}p"] = f"""SELECT id, target, 1 / (1 + exp(-sum(w))) AS p
        FROM descent_rows JOIN batch{_step}w USING (feature) JOIN batch_places USING (id)
        WHERE batch = {_step % 4} GROUP BY id, target"""
    _VIEWS[f"batch{_step}g"] = f"""
        SELECT feature, sum(2 * (p - r.target) * p * (1 - p)) / (SELECT count(*) FROM batch{_step}p) AS g
        FROM descent_rows r JOIN batch{_step}p USING (id) GROUP BY feature"""
    _VIEWS[f"batch{_step + 1}w"] = f"""SELECT feature, w - coalesce(g, 0) AS w
        FROM batch{_step}w LEFT JOIN batch{_step}g USING (feature)"""

# the network runs of the grid: two steps of rate 0.5 from fixed weights; 0 units are logistic
_VIEWS["grid_rows"] = """SELECT weighting, id, split, target, feature, value FROM lrows
    UNION ALL SELECT weighting, id, split, target, '1', 1.0::DOUBLE FROM tokens
      CROSS JOIN (VALUES ('Frequency'), ('Binary'), ('TFIDF')) w(weighting) WHERE target IS NOT NULL"""
_VIEWS["grid_units"] = """SELECT 0 AS hidden, 0 AS unit UNION ALL SELECT 20, unnest(range(20))"""
_VIEWS["grid0w"] = """SELECT DISTINCT weighting, hidden, unit, feature,
      ((length(feature) + 3 * unit) % 7 - 3) / 64e0 AS w
    FROM grid_rows CROSS JOIN grid_units WHERE split = 'train'"""
_VIEWS["grid0o"] = """SELECT weighting, unit, CASE WHEN unit = 20 THEN 0 ELSE (2 * unit % 5 - 2) / 4e0 END AS o
    FROM (VALUES ('Frequency'), ('Binary'), ('TFIDF')) w(weighting) CROSS JOIN (SELECT unnest(range(21)) AS unit)"""
for _step in range(3):
    _VIEWS[f"grid{_step}a"] = f"""SELECT weighting, hidden, unit, id, split, target,
          1 / (1 + exp(-greatest(least(sum(value * w), 700), -700))) AS a
        FROM grid_rows JOIN grid{_step}w USING (weighting, feature)
        GROUP BY weighting, hidden, unit, id, split, target"""
    _VIEWS[f"grid{_step}p"] = f"""SELECT weighting, hidden, id, split, target,
          CASE WHEN hidden = 0 THEN any_value(a) ELSE 1 / (1 + exp(-(sum(a * o) + any_value(ob)))) END AS p
        FROM grid{_step}a LEFT JOIN grid{_step}o USING (weighting, unit)
          JOIN (SELECT weighting, o AS ob FROM grid{_step}o WHERE unit = 20) USING (weighting)
        GROUP BY weighting, hidden, id, split, target"""
    _VIEWS[f"grid{_step}s"] = f"""SELECT weighting, hidden, id,
          2 * (p - target) * p * (1 - p) / count(*) OVER (PARTITION BY weighting, hidden) AS slope
        FROM grid{_step}p WHERE split = 'train'"""
    _VIEWS[f"grid{_step}b"] = f"""SELECT weighting, hidden, unit, id, slope, a,
          CASE WHEN hidden = 0 THEN slope ELSE slope * o * a * (1 - a) END AS back
        FROM grid{_step}s JOIN grid{_step}a USING (weighting, hidden, id)
          LEFT JOIN grid{_step}o USING (weighting, unit)"""
    _VIEWS[f"grid{_step + 1}w"] = f"""SELECT weighting, hidden, unit, feature, any_value(w) - 0.5e0 * sum(value * back) AS w
        FROM grid_rows JOIN grid{_step}b USING (weighting, id) JOIN grid{_step}w USING (weighting, hidden, unit, feature)
        GROUP BY weighting, hidden, unit, feature"""
    _VIEWS[f"grid{_step + 1}o"] = f"""SELECT weighting, unit, o - 0.5e0 * g AS o FROM grid{_step}o JOIN (
          SELECT weighting, unit, sum(slope * a) AS g FROM grid{_step}b WHERE hidden = 20 GROUP BY weighting, unit
          UNION ALL SELECT weighting, 20, sum(slope) FROM grid{_step}s WHERE hidden = 20 GROUP BY weighting) USING (weighting, unit)"""
_VIEWS["grid_preds"] = """
    SELECT weighting || CASE WHEN hidden = 0 THEN '-Logistic' ELSE '-FFNN' END AS run, target,
      CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS pred
    FROM grid2p WHERE split = 'test'
    UNION ALL SELECT weighting || '-NaiveBayes', target, pred FROM nb_preds"""

_CELLS = """count(*) FILTER (pred = 0 AND target = 0) AS tn,
    count(*) FILTER (pred = 0 AND target = 1) AS fn,
    count(*) FILTER (pred = 1 AND target = 0) AS fp,
    count(*) FILTER (pred = 1 AND target = 1) AS tp"""
_ACCURACY = "round(avg(CASE WHEN pred = target THEN 1e0 ELSE 0e0 END), 6) AS accuracy"
_RUNS = "'NoStem-' || weighting || '-NaiveBayes' AS run_id"

_FINAL = {
    "split_counts": "SELECT split, count(*) AS n_posts FROM posts GROUP BY split",
    "posts_csv": "SELECT id, keyword, location, sha256(text) AS text_sha256, target FROM posts",
    "submission": "SELECT id, pred AS target FROM preds",
    "keyword_index": "SELECT keyword, keywd FROM keyword_ids",
    "keyword_encode": """SELECT p.id, coalesce(k.keywd, -1) AS keywd FROM posts p
        LEFT JOIN keyword_ids k ON k.keyword IS NOT DISTINCT FROM p.keyword""",
    "location_flag": "SELECT id, CASE WHEN location IS NULL THEN 0 ELSE 1 END AS loc FROM posts",
    "url_count": f"SELECT id, len(regexp_extract_all(text, {_q(P.URL)}))::INTEGER AS url FROM posts",
    "strip_urls": f"SELECT id, {_strip('text', P.URL)} AS text FROM posts",
    "strip_entities": f"SELECT id, {_strip('text', P.ENTITY)} AS text FROM posts",
    "strip_numbers": f"SELECT id, {_strip('text', P.NUMBER, ' ')} AS text FROM posts",
    "lower_capitalized": f"SELECT id, {_lower_capitalized('text')} AS text FROM posts",
    "strip_tags": f"SELECT id, {_strip('text', P.TAG)} AS text FROM posts",
    "clean_text": "SELECT id, text FROM cleaned",
    "match_key": f"SELECT id, {_strip('text', P.NOT_ALNUM)} AS text FROM posts",
    "stopwords_strict": "SELECT id, array_to_string(pieces, ' ') AS text FROM kept",
    "stopwords_legacy": f"""
        SELECT id, piece, count(*)::INTEGER AS n FROM (
          SELECT id, piece, stop, row_number() OVER (PARTITION BY id, island ORDER BY pos) AS nth
          FROM (
            SELECT *, pos - row_number() OVER (PARTITION BY id, stop ORDER BY pos) AS gap,
              CASE WHEN stop THEN gap ELSE -1 - pos END AS island
            FROM (SELECT id, unnest(pieces) AS piece,
                    generate_subscripts(pieces, 1) AS pos, lower(piece) IN ({_STOPS}) AS stop
                  FROM pieces)))
        WHERE NOT stop OR nth % 2 = 0 GROUP BY id, piece""",
    "tokenize": "SELECT id, array_to_string(raw, chr(10)) AS tokens FROM raw_tokens",
    "split_contractions": "SELECT id, array_to_string(tokens, chr(10)) AS tokens FROM tokens",
    "token_corpus": """SELECT id, split, len(tokens)::INTEGER AS n_tokens,
        array_to_string(tokens, chr(10)) AS tokens FROM tokens""",
    "vocabulary": "SELECT DISTINCT term FROM words WHERE split = 'train'",
    "vocab_size": "SELECT count(DISTINCT term) AS vocab_size FROM words WHERE split = 'train'",
    "joint_vocab": "SELECT term, term_id FROM joint",
    "max_len": "SELECT max(len(tokens))::INTEGER AS max_len FROM tokens",
    "sequence_encode": """
        SELECT t.id, array_to_string(list_resize(coalesce(e.ids, []), f.max_len, f.pad_id), ',') AS ids,
          f.max_len, f.pad_id
        FROM tokens t CROSS JOIN (
          SELECT (SELECT max(len(tokens)) FROM tokens)::INTEGER AS max_len,
            (SELECT max(term_id) FROM joint) AS pad_id) f
        LEFT JOIN (
          SELECT id, list(term_id ORDER BY pos) AS ids
          FROM (SELECT id, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS pos FROM tokens)
          JOIN joint USING (term) GROUP BY id) e ON e.id = t.id""",
    "oov_filter": """SELECT id, term, tf, term IN (SELECT term FROM train_df) AS known FROM tf""",
    "term_frequency": "SELECT id, term, tf FROM tf",
    "term_binary": "SELECT DISTINCT id, term FROM words",
    "log_tf": "SELECT id, term, round(1 + log10(tf), 6) AS log_tf FROM tf",
    "doc_frequency": "SELECT term, df FROM train_df",
    "idf": "SELECT term, df, round(idf, 6) AS idf FROM train_idf",
    "tfidf": """SELECT id, term, round((1 + log10(tf)) * idf, 6) AS tfidf
        FROM tf JOIN train_idf USING (term) WHERE split = 'train'""",
    "tfidf_test": """SELECT id, term, round((1 + log10(tf)) * idf, 6) AS tfidf
        FROM tf JOIN train_idf USING (term) WHERE split = 'test'""",
    "keyword_onehot": """SELECT id, coalesce('kw:' || keyword, 'kw') AS feature,
        1.0::DOUBLE AS value FROM posts""",
    "assemble_features": """
        SELECT id, 'w:' || term AS feature, round((1 + log10(tf)) * idf, 6) AS value
        FROM tf JOIN train_idf USING (term)
        UNION ALL SELECT id, feature, round(value, 6) FROM meta
        WHERE feature IN ('loc', 'url') OR feature IN
          (SELECT coalesce('kw:' || keyword, 'kw') FROM train_keywords)""",
    "feature_dims": """
        SELECT n_terms, n_keywords, n_terms + n_keywords + 2 AS dims FROM
          (SELECT (SELECT count(*) FROM train_df) AS n_terms,
                  (SELECT count(*) FROM train_keywords) AS n_keywords)""",
    "nb_prior": "SELECT label, round(log_prior, 6) AS log_prior FROM prior",
    "nb_likelihood": """SELECT feature, round(ll0, 6) AS ll0, round(ll1, 6) AS ll1
        FROM lik WHERE weighting = 'Frequency'""",
    "nb_score": """SELECT id, round(score0, 4) AS score0, round(score1, 4) AS score1
        FROM scores WHERE weighting = 'Frequency'""",
    "nb_predict": "SELECT id, target, pred FROM nb_preds WHERE weighting = 'Frequency'",
    "nb_predict_all": """SELECT id, CASE WHEN score1 > score0 THEN 1 ELSE 0 END AS pred
        FROM scores_all""",
    "nb_grid": f"SELECT {_RUNS}, {_ACCURACY}, {_CELLS} FROM nb_preds GROUP BY weighting",
    "nb_experiment": f"""SELECT {_RUNS}, {_ACCURACY}, {_CELLS} FROM nb_preds
        WHERE weighting = 'Frequency' GROUP BY weighting""",
    "logistic_score": """SELECT id, target, round(p, 6) AS p,
        CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS pred FROM fixed_all""",
    "mse_gradient_step": """
        SELECT 'w:' || term AS feature, round((length(term) - 5) / 8192e0
          - 0.1e0 * sum(slope) / (SELECT count(*) FROM fixed), 8) AS w
        FROM ltf JOIN slopes USING (id) GROUP BY term
        UNION ALL SELECT '1', round(-0.1e0 * sum(slope) / (SELECT count(*) FROM fixed), 8)
        FROM slopes""",
    "logistic_descent": "SELECT feature, round(w, 8) AS w FROM descent3",
    "mlp_descent": """
        SELECT feature, 0 AS unit, round(a, 8) AS w FROM net2
        UNION ALL SELECT feature, 1, round(b, 8) FROM net2
        UNION ALL SELECT '2', 0, round(oa, 8) FROM out2
        UNION ALL SELECT '2', 1, round(ob, 8) FROM out2
        UNION ALL SELECT '2', 2, round(oc, 8) FROM out2""",
    "minibatch": """SELECT id, ((row_number() OVER (ORDER BY id) - 1) // 256) AS batch
        FROM posts""",
    "epoch_metrics": """
        SELECT 1 AS epoch, round(avg(mse) FILTER (split = 'train'), 6) AS loss,
          round(100e0 * sum(hits) FILTER (split = 'train') / sum(n) FILTER (split = 'train'), 6)
            AS train_acc,
          round(100e0 * sum(hits) FILTER (split = 'test') / sum(n) FILTER (split = 'test'), 6)
            AS test_acc
        FROM (
          SELECT split, batch, avg((p - target) * (p - target)) AS mse, count(*) AS n,
            count(*) FILTER ((p > 0.5) = (target = 1)) AS hits
          FROM (SELECT *, (row_number() OVER (PARTITION BY split ORDER BY id) - 1) // 256 AS batch
                FROM fixed)
          GROUP BY split, batch)""",
    "stored_stages": """
        SELECT 'tokens' AS kind, count(*) AS n, round(sum(len(tokens))::DOUBLE, 3) AS total FROM tokens
        UNION ALL SELECT 'keywords', count(*), round(sum(keywd)::DOUBLE, 3) FROM keyword_ids
        UNION ALL SELECT 'vocabulary', count(*), round(sum(length(term))::DOUBLE, 3) FROM train_df
        UNION ALL SELECT 'idf', count(*), round(sum(idf), 3) FROM train_idf
        UNION ALL SELECT 'model', count(*), round(sum(ll0), 3) FROM lik WHERE weighting = 'Frequency'
        UNION ALL SELECT 'predictions', count(*), round(sum(pred)::DOUBLE, 3) FROM nb_preds WHERE weighting = 'Frequency'""",
    "shuffled_order": "SELECT id, row_number() OVER (ORDER BY md5('7|' || id), id) - 1 AS place FROM posts",
    "batch_descent": "SELECT feature, round(w, 8) AS w FROM batch8w",
    "network_score": """
        SELECT id, target, round(p, 6) AS p, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS pred FROM (
          SELECT id, target, 1 / (1 + exp(-(0.5e0 / (1 + exp(-z)) - 0.25e0 / (1 + exp(z / 2)) + 0.125e0))) AS p
          FROM (SELECT t.id, t.target, coalesce(sum((length(f.term) - 5) / 8192e0), 0) AS z
                FROM tokens t LEFT JOIN tf f ON f.id = t.id GROUP BY t.id, t.target))""",
    "random_vectors": """
        SELECT * FROM (WITH starts AS (
          SELECT term, ('0x' || substr(md5('7|' || term), 1, 15))::BIGINT % 2147483647 AS a,
            ('0x' || substr(md5('7|' || term), 16, 15))::BIGINT % 2147483647 AS b
          FROM (SELECT DISTINCT term FROM words)),
        draws AS (SELECT term, a, b, j, (a + j * b) % 2147483647 AS x
          FROM starts CROSS JOIN (SELECT unnest(range(8)) AS j)),
        twice AS (SELECT *, (x * x + a) % 2147483647 AS y FROM draws),
        uniform AS (SELECT term, j, ((y * y + b) % 2147483647 + 1) / 2147483648e0 AS u FROM twice)
        SELECT r.term, (r.j // 2)::INTEGER AS pos,
          round((sqrt(-2 * ln(r.u)) * cos(2 * pi() * s.u))::FLOAT::DOUBLE, 4) AS x
        FROM uniform r JOIN uniform s ON s.term = r.term AND s.j = r.j + 1 WHERE r.j % 2 = 0)""",
    "best_checkpoint": """
        SELECT run_id, epoch, test_acc FROM (
          SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY epoch DESC) AS back FROM (
            SELECT *, max(test_acc) OVER (PARTITION BY run_id ORDER BY epoch
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM history)
          WHERE test_acc > greatest(coalesce(top, 0), 0)) WHERE back = 1""",
    "early_stop": """
        SELECT run_id, min(epoch) FILTER (epoch >= 5 AND test_acc < low) AS stop_epoch FROM (
          SELECT *, min(test_acc) OVER (PARTITION BY run_id ORDER BY epoch
            ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS low FROM history)
        GROUP BY run_id""",
    "post_vectors": """
        SELECT t.id, k - 1 AS pos, round(coalesce(avg((length(w.term) * k % 7)::DOUBLE), 0), 6) AS mean_value
        FROM tokens t CROSS JOIN (VALUES (1), (2), (3)) v(k) LEFT JOIN words w ON w.id = t.id
        GROUP BY t.id, k""",
    "sequence_score": """
        SELECT id, round(p, 6) AS p, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS pred FROM (
          SELECT id, 1 / (1 + exp(0.25e0 - sum(weight * mean))) AS p FROM (
            SELECT t.id, k, any_value(weight) AS weight,
              coalesce(avg((length(w.term) * k % 7)::DOUBLE), 0) AS mean
            FROM tokens t CROSS JOIN (VALUES (1, 0.5e0), (2, -0.375e0), (3, 0.125e0)) v(k, weight)
              LEFT JOIN words w ON w.id = t.id
            GROUP BY t.id, k) GROUP BY id)""",
    "embedding_pool": """
        SELECT label, (pos - 1)::INTEGER AS pos, round(avg(x::DOUBLE), 6) AS mean_value FROM (
          SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos
          FROM embeddings) GROUP BY label, pos""",
    "argmax_scores": """SELECT vec_id, list_position(embedding, list_max(embedding)) - 1 AS best
        FROM embeddings""",
    "confusion_matrix": """
        SELECT p.pred, count(*) FILTER (target = 0) AS actual0,
          count(*) FILTER (target = 1) AS actual1
        FROM (VALUES (0), (1)) p(pred) LEFT JOIN preds USING (pred) GROUP BY p.pred""",
    "accuracy": f"SELECT {_ACCURACY} FROM preds",
    "eval_report": f"SELECT 'fixed-rule' AS run_id, {_ACCURACY}, {_CELLS} FROM preds",
    "label_match": "SELECT id, target FROM matched",
    "add_labels": """SELECT d.doc_id AS id, length(d.text) AS n_chars, m.target
        FROM documents d JOIN matched m ON m.id = d.doc_id""",
    "label_conflicts": """
        SELECT key, count(*) FILTER (label = 0) AS n_zero, count(*) FILTER (label = 1) AS n_one
        FROM gold_keys GROUP BY key HAVING min(label) <> max(label)""",
    "unmatched": "SELECT id FROM matched WHERE target = -1",
}
_FINAL["rescore"] = _FINAL["nb_experiment"]


# The same over stemmed tokens: every view from the words on reads the stemmed ones.
_STEMMED = {
    **{name: sql for name, sql in _VIEWS.items() if name in ("tokens", "words")},
    **oracles_stem.views(),
    "stemmed": """SELECT t.id, any_value(t.keyword) AS keyword, any_value(t.target) AS target,
          t.split, coalesce(list(s.stem ORDER BY w.pos) FILTER (s.stem IS NOT NULL), []) AS tokens
        FROM tokens t
          LEFT JOIN (SELECT id, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS pos
                     FROM tokens) w ON w.id = t.id
          LEFT JOIN stems s ON s.token = w.term
        GROUP BY t.id, t.split""",
    "stemmed_words": "SELECT id, split, target, unnest(tokens) AS term FROM stemmed",
    "tf": _VIEWS["tf"].replace("FROM words", "FROM stemmed_words"),
}
_STEMMED_FINAL = {
    "stem_tokens": "SELECT token, stem FROM stems",
    "token_corpus_stems": """SELECT id, split, len(tokens)::INTEGER AS n_tokens,
        array_to_string(tokens, chr(10)) AS tokens FROM stemmed""",
    "nb_grid_stems": f"""SELECT 'Stem-' || weighting || '-NaiveBayes' AS run_id, {_ACCURACY},
        {_CELLS} FROM nb_preds GROUP BY weighting""",
}


def _in_order(views: dict[str, str], sql: str, found: list[str]) -> list[str]:
    """Names of the views a statement needs, each after the views it needs itself."""
    for name in re.findall(r"\b(?:FROM|JOIN) (\w+)", sql):
        if name in views and name not in found:
            _in_order(views, views[name], found)
            if name not in found:
                found.append(name)
    return found


def _statement(final: str, views: dict[str, str]) -> str:
    needed = _in_order(views, final, [])
    parts = [f"{name} AS MATERIALIZED ({views[name]})" for name in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + final


def _grid(stemming: str, views: dict[str, str]) -> str:
    report = f"SELECT '{stemming}-' || run AS run_id, {_ACCURACY}, {_CELLS} FROM grid_preds GROUP BY run"
    return f"SELECT * FROM ({_statement(report, views)})"


def statements() -> dict[str, str]:
    plain = {name: _statement(final, _VIEWS) for name, final in _FINAL.items()}
    views = {**_VIEWS, **_STEMMED}
    stemmed = {name: _statement(final, views) for name, final in _STEMMED_FINAL.items()}
    return plain | stemmed | {"grid": f"{_grid('NoStem', _VIEWS)} UNION ALL {_grid('Stem', views)}"}
