"""DuckDB SQL fragments shared by the oracle queries (kept as text)."""

from __future__ import annotations


def words_cte(source: str, id_col: str = "doc_id", text_col: str = "text", name: str = "words") -> str:
    """One row per token: runs of ASCII letters, lower-cased after extraction."""
    return (f"{name} AS (SELECT {id_col} AS doc_id, lower(w) AS word FROM "
            f"(SELECT {id_col}, unnest(regexp_extract_all({text_col}, '[a-zA-Z]+')) AS w FROM {source}))")


def vocab_cte(size: int, words: str = "words", name: str = "vocab", stop_filter: str = "") -> str:
    where = f"WHERE {stop_filter}" if stop_filter else ""
    return (f"{name} AS (SELECT word, CAST(row_number() OVER (ORDER BY n DESC, word) - 1 AS INTEGER) AS pos "
            f"FROM (SELECT word, count(*) AS n FROM {words} {where} GROUP BY word "
            f"ORDER BY n DESC, word LIMIT {size}))")


def features_ctes(size: int, source: str = "documents", n_docs_sql: str = "(SELECT count(*) FROM documents)",
                  stop_filter: str = "") -> str:
    """words, vocab, terms (doc,pos,n), tf, idf, tfidf."""
    where = f"WHERE {stop_filter}" if stop_filter else ""
    return ",\n".join([
        words_cte(source),
        vocab_cte(size, stop_filter=stop_filter),
        f"terms AS (SELECT doc_id, pos, count(*) AS n FROM (SELECT * FROM words {where}) JOIN vocab USING (word) "
        f"GROUP BY doc_id, pos)",
        "tf AS (SELECT doc_id, pos, n / sum(n) OVER (PARTITION BY doc_id) AS tf FROM terms)",
        f"idf AS (SELECT pos, ln(CAST({n_docs_sql} AS DOUBLE) / count(*)) AS idf FROM terms GROUP BY pos)",
        "tfidf AS (SELECT doc_id, pos, tf * idf AS tfidf FROM tf JOIN idf USING (pos))",
    ])


def query_scores_ctes(query_text_sql: str, name: str = "scores") -> str:
    """qwords, qvec and per-document scores (0 for documents sharing no word)."""
    return ",\n".join([
        f"qwords AS (SELECT lower(unnest(regexp_extract_all(t, '[a-zA-Z]+'))) AS word FROM ({query_text_sql}) AS q(t))",
        "qterms AS (SELECT pos, count(*) AS n FROM qwords JOIN vocab USING (word) GROUP BY pos)",
        "qvec AS (SELECT pos, n / sum(n) OVER () * idf AS w FROM qterms JOIN idf USING (pos))",
        f"{name} AS (SELECT d.doc_id, coalesce(s.score, 0.0) AS score FROM (SELECT DISTINCT doc_id FROM tf) d "
        "LEFT JOIN (SELECT doc_id, sum(tfidf * w) AS score FROM tfidf JOIN qvec USING (pos) GROUP BY doc_id) s "
        "USING (doc_id))",
    ])


def sig(expr: str, digits: int = 8) -> str:
    """SQL twin of ``functions.numeric.significant``."""
    return f"CAST(printf('%.{digits - 1}e', CAST({expr} AS DOUBLE)) AS DOUBLE)"


def gd_trace_sql(design_sql: str, d: int, names: list[str], w0: float, lr: float, iters: int,
                 scale_by_n: bool, additive_delta: float | None = None, digits: int = 8) -> str:
    """Recursive-CTE gradient descent on sufficient statistics of ``design_sql``
    (columns x0..x{d-1}, y); output rows match ``stats.gd_trace``."""
    sums = ["CAST(count(*) AS DOUBLE) AS n", "sum(y * y) AS yty"]
    for i in range(d):
        sums.append(f"sum(x{i} * y) AS xy{i}")
        for j in range(i, d):
            sums.append(f"sum(x{i} * x{j}) AS xx{i}_{j}")

    def xx(i, j):
        return f"xx{min(i, j)}_{max(i, j)}"

    ws = [f"w{i}" for i in range(d)]
    loss = "(yty - 2.0 * (" + " + ".join(f"w{i} * xy{i}" for i in range(d)) + ") + (" + \
        " + ".join(f"w{i} * w{j} * {xx(i, j)}" for i in range(d) for j in range(d)) + "))"
    scale = "(2.0 / n) * " if scale_by_n else ""
    grads = [f"{scale}((" + " + ".join(f"{xx(i, j)} * w{j}" for j in range(d)) + f") - xy{i})" for i in range(d)]
    upd = [f"w{i} - lr * {grads[i]}" for i in range(d)]
    if additive_delta is not None:
        lr_next = f"CASE WHEN {loss} < prev THEN lr + {additive_delta!r} ELSE lr - {additive_delta!r} END"
    else:
        lr_next = "lr"
    init = ", ".join([f"CAST({w0!r} AS DOUBLE)"] * d)
    cols = ", ".join(ws)
    out = ", ".join(f"{sig(f'w{i}', digits)} AS {names[i]}" for i in range(d))
    return f"""
WITH RECURSIVE dm AS ({design_sql}),
s AS (SELECT {', '.join(sums)} FROM dm),
it(iteration, {cols}, lr, prev, loss, lr_used) AS (
  SELECT 0, {init}, CAST({lr!r} AS DOUBLE), CAST(1.7976931348623157e308 AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
  UNION ALL
  SELECT iteration + 1, {', '.join(upd)}, {lr_next}, {loss}, {loss}, lr FROM it, s WHERE iteration < {iters})
SELECT CAST(iteration - 1 AS INTEGER) AS iteration, {sig('loss', digits)} AS loss, {sig('lr_used', digits)} AS lr, {out}
FROM it WHERE iteration >= 1
"""
