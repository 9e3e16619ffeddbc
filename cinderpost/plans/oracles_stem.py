"""Porter stems as plain SQL: one view per step, each with the word and its letter shape.

In a shape ``V`` is a vowel and ``C`` any other sign; it is computed by replacements alone, so
it shares nothing with the library but the suffix tables.
"""

from __future__ import annotations

from cinderpost.functions import porter


def _shape(word: str) -> str:
    out = f"regexp_replace(regexp_replace({word}, '[aeiou]', 'V', 'g'), '[^Vy]', 'C', 'g')"
    out = f"regexp_replace({out}, '^y', 'C')"
    for _ in range(4):
        out = f"regexp_replace(regexp_replace({out}, 'Cy', 'CV', 'g'), 'Vy', 'VC', 'g')"
    return out


def _cut(column: str, k: int) -> str:
    return f"left({column}, length(w) - {k})"


def _measure(shape: str) -> str:
    return f"len(regexp_extract_all({shape}, 'V+C+'))"


def _short_end(word: str, shape: str) -> str:
    return (
        f"((right({shape}, 3) = 'CVC' AND right({word}, 1) NOT IN ('w', 'x', 'y'))"
        f" OR {shape} = 'VC')"
    )


def _rules(rules) -> str:
    """Of the rules (suffix, replacement, condition) the first whose suffix fits decides."""
    cases = " ".join(
        f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN {condition}"
        f" THEN {_cut('w', len(suffix))} || '{by}' ELSE w END"
        for suffix, by, condition in sorted(rules, key=lambda rule: -len(rule[0]))
    )
    return f"CASE {cases} ELSE w END"


def _above(k: int, least: int) -> str:
    return f"{_measure(_cut('s', k))} > {least}"


def _step_2() -> str:
    table = [pair for pair in porter.STEP_2 if pair[0] != "abli"]
    table += [("bli", "ble"), ("fulli", "ful")]
    rules = [(suffix, by, _above(len(suffix), 0)) for suffix, by in table]
    return _rules([*rules, ("logi", "log", _above(3, 0))])


def _step_4() -> str:
    rules = []
    for suffix in porter.STEP_4:
        condition = _above(len(suffix), 1)
        if suffix == "ion":
            condition += " AND substr(w, length(w) - 3, 1) IN ('s', 't')"
        rules.append((suffix, "", condition))
    return _rules(rules)


_STEPS = (
    # plural
    """CASE WHEN length(w) = 4 AND ends_with(w, 'ies') THEN left(w, 3)
        WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN left(w, length(w) - 2)
        WHEN ends_with(w, 'ss') THEN w
        WHEN ends_with(w, 's') THEN left(w, length(w) - 1) ELSE w END""",
    # past and -ing; "|" marks a word whose ending was cut off
    f"""CASE WHEN ends_with(w, 'ied') THEN left(w, length(w) - if(length(w) = 4, 1, 2))
        WHEN ends_with(w, 'eed') THEN if({_above(3, 0)}, left(w, length(w) - 1), w)
        WHEN ends_with(w, 'ed') AND contains({_cut('s', 2)}, 'V') THEN {_cut('w', 2)} || '|'
        WHEN ends_with(w, 'ing') AND contains({_cut('s', 3)}, 'V') THEN {_cut('w', 3)} || '|'
        ELSE w END""",
    f"""CASE WHEN right(w, 1) <> '|' OR length(t) = 0 OR marked = 0 THEN w
        WHEN right(t, 2) IN ('at', 'bl', 'iz') THEN t || 'e'
        WHEN length(t) > 1 AND right(t, 1) = left(right(t, 2), 1) AND right(ts, 1) = 'C'
          THEN if(right(t, 1) IN ('l', 's', 'z'), t, left(t, length(t) - 1))
        WHEN {_measure('ts')} = 1 AND {_short_end('t', 'ts')} THEN t || 'e' ELSE t END""",
    # final y
    f"""CASE WHEN ends_with(w, 'y') AND length(w) > 2 AND right({_cut('s', 1)}, 1) = 'C'
        THEN {_cut('w', 1)} || 'i' ELSE w END""",
    # double suffixes, first -alli
    f"if(ends_with(w, 'alli') AND {_above(4, 0)}, {_cut('w', 2)}, w)",
    _step_2(),
    _rules([(suffix, by, _above(len(suffix), 0)) for suffix, by in porter.STEP_3]),
    _step_4(),
    # final e, double l
    f"""CASE WHEN ends_with(w, 'e') AND ({_above(1, 1)} OR ({_measure(_cut('s', 1))} = 1
        AND NOT {_short_end(_cut('w', 1), _cut('s', 1))})) THEN {_cut('w', 1)} ELSE w END""",
    f"if(ends_with(w, 'll') AND {_above(1, 1)}, {_cut('w', 1)}, w)",
)


def views() -> dict[str, str]:
    """``stems (token, stem)`` and the views it needs, over the view ``words``."""
    out = {"stem0": "SELECT token, lower(token) AS w FROM (SELECT DISTINCT term AS token FROM words)"}
    for number, step in enumerate(_STEPS):
        source = f"SELECT token, w, {_shape('w')} AS s FROM stem{number}"
        if number == 2:
            # The word without its mark, for words the step before has cut.
            source = f"""SELECT *, {_shape('t')} AS ts FROM (
                SELECT c.token, c.w, left(c.w, length(c.w) - 1) AS t,
                  if(c.w <> p.w AND right(c.w, 1) = '|', 1, 0) AS marked
                FROM stem2 c JOIN stem1 p ON p.token = c.token)"""
        out[f"stem{number + 1}"] = f"SELECT token, {step} AS w FROM ({source})"
    irregular = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in porter.IRREGULAR.items())
    out["stems"] = f"""SELECT token, CASE WHEN length(lower(token)) <= 2 THEN lower(token)
        ELSE CASE lower(token) {irregular} ELSE w END END AS stem FROM stem{len(_STEPS)}"""
    return out
