"""The queries of this subpackage, and DuckDB statements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contrail.llm import (
    alignment,
    decontamination,
    embeddings,
    language,
    lines,
    markup,
    minhash,
    mixing,
    spelling,
    token_files,
    toxicity,
    urls,
    winnowing,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_decontamination": decontamination.op1_decontamination,
        "op2_mixing": mixing.op2_mixing,
        "op3_language": language.op3_language,
        "op4_html": markup.op4_html,
        "op5_lines": lines.op5_lines,
        "op6_minhash": minhash.op6_minhash,
        "op7_token_files": token_files.op7_token_files,
        "op8_embeddings": embeddings.op8_embeddings,
        "op9_url_rules": urls.op9_url_rules,
        "op10_toxicity": toxicity.op10_toxicity,
        "op11_alignment": alignment.op11_alignment,
        "op12_spelling": spelling.op12_spelling,
        "op13_winnowing": winnowing.op13_winnowing,
    }


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(separators: str) -> str:
    return (
        f"list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{separators}'),"
        " lambda x: x <> '')"
    )


def _windows(source: str, key: str, length: str, extra: str = "") -> str:
    """(key, place, win): the windows of ``length`` words of each row of ``source``."""
    return (
        f"SELECT {key}, place{extra}, w[place + 1 : place + {length}] AS win FROM"
        f" (SELECT *, unnest(range(0, len(w) - {length} + 1)) AS place FROM {source} WHERE len(w) >= {length})"
    )


def _masked(places: list[int]) -> str:
    return "concat_ws(' ', " + ", ".join(f"win[{p + 1}]" for p in places) + ")"


def _decontamination() -> str:
    # The four blocks of three words of a twelve-word window, two of which a mask keeps.
    blocks = [[0, 1, 2], [3, 4, 5], [6, 7, 8], [9, 10, 11]]
    kept = [blocks[a] + blocks[b] for a in range(4) for b in range(a + 1, 4)]
    met = " UNION ALL ".join(
        "SELECT d.doc_id, i.item_id, d.place, d.place - i.place AS along, 12 AS length FROM doc_windows d JOIN item_windows i"
        f" ON {_masked(m).replace('win[', 'd.win[')} = {_masked(m).replace('win[', 'i.win[')}"
        " WHERE list_sum(list_transform(range(1, 13), lambda k: CAST(d.win[k] <> i.win[k] AS INT))) <= 2"
        for m in kept
    )
    words = _words(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    return f"""
    WITH docs AS (SELECT doc_id, {words} AS w FROM documents),
    items AS (SELECT item_id, {words} AS w FROM benchmark),
    doc_windows AS ({_windows('docs', 'doc_id', '12')}),
    all_items AS ({_windows('items', 'item_id', '12')}),
    item_windows AS (SELECT win, item_id, place FROM all_items),
    short_items AS (SELECT DISTINCT array_to_string(w, ' ') AS words, len(w) AS n, item_id FROM items
      WHERE len(w) BETWEEN 5 AND 11),
    short_docs AS (SELECT doc_id, n, place, array_to_string(w[place + 1 : place + n], ' ') AS words FROM
      (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS place
        FROM docs JOIN (SELECT DISTINCT n FROM short_items) ON len(w) >= n)),
    met AS ({met} UNION ALL SELECT d.doc_id, i.item_id, d.place, d.place AS along, d.n AS length
      FROM short_docs d JOIN short_items i ON d.words = i.words AND d.n = i.n),
    spans AS (SELECT doc_id, item_id, along, max(place + length) - min(place) AS n FROM (SELECT DISTINCT * FROM met) GROUP BY ALL),
    found AS (SELECT doc_id, count(*) AS n_overlaps, max(n) AS longest, max([n, -item_id]) AS best FROM spans GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n_overlaps, 0) AS "overlaps", CAST(coalesce(longest, 0) AS INT) AS longest,
      CAST(-best[2] AS BIGINT) AS item_id, n_overlaps IS NOT NULL AS contaminated
    FROM documents d LEFT JOIN found f ON d.doc_id = f.doc_id"""


def _reached(nodes: str, links: str) -> str:
    """Common table expressions: ``reached`` (node, other) from links (x, y)."""
    return (
        f"both_ways AS (SELECT x, y FROM {links} UNION ALL SELECT y, x FROM {links}),"
        f" reached(node, other) AS (SELECT node, node FROM {nodes}"
        " UNION SELECT r.node, b.y FROM reached r JOIN both_ways b ON r.other = b.x)"
    )


def _minhash() -> str:
    return f"""
    WITH RECURSIVE docs AS (SELECT doc_id AS node, {_words(r"[\x20\x09-\x0D]+")} AS w FROM documents),
    shingles AS (SELECT DISTINCT node, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s FROM docs),
    sizes AS (SELECT node, count(*) AS n FROM shingles GROUP BY node),
    shared AS (SELECT a.node AS x, b.node AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.node < b.node
      GROUP BY ALL),
    links AS (SELECT x, y FROM shared JOIN sizes a ON a.node = x JOIN sizes b ON b.node = y
      WHERE 100 * shared.n >= 75 * (a.n + b.n - shared.n)),
    {_reached('docs', 'links')}
    SELECT r.node AS doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(other) AS component_id, r.node = min(other) AS kept
    FROM reached r LEFT JOIN sizes s ON s.node = r.node GROUP BY r.node"""


def _embeddings() -> str:
    return f"""
    WITH RECURSIVE vectors AS (SELECT vec_id AS node, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    sound AS (SELECT node, v FROM vectors WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(v, lambda x: x <> 0)) > 0),
    links AS (SELECT a.node AS x, b.node AS y FROM sound a JOIN sound b ON a.node < b.node AND list_cosine_similarity(a.v, b.v) >= 0.95),
    {_reached('vectors', 'links')}
    SELECT node AS vec_id, (SELECT count(*) FROM both_ways b WHERE b.x = node) AS n_links, min(other) AS component_id,
      node = min(other) AS kept FROM reached GROUP BY node"""


def _url_rules() -> str:
    # The rules as the contract states them.
    rules = (
        "('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),"
        " ('com', '/fr/', 'allow'), ('com', '/de/', 'block')"
    )
    return f"""
    WITH rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
    rules(rule_host, rule_path, verdict) AS (VALUES {rules}),
    fits AS (SELECT page_id, rule_host || rule_path AS rule, verdict,
      row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS place
      FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
    SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
    FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND place = 1"""


def oracle_sql() -> dict[str, str]:
    """Statements of the queries that SQL can express.

    It has neither the hash that orders the draws of the mix, nor an edit distance in characters, nor
    tokenizers, checksums, trained models or a renderer of pages; those queries are tested against brute force.
    """
    return {
        "op1_decontamination": _decontamination(),
        "op6_minhash": _minhash(),
        "op8_embeddings": _embeddings(),
        "op9_url_rules": _url_rules(),
    }
