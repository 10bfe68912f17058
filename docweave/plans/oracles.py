"""The registered queries as SQL over the same tables, for comparison.

Written apart from the operators: windows partitioned by epoch instead of
running maxima, and a recursive query per row for state that expires.
"""

from __future__ import annotations

# ------------------------------------------------------------ the change stream

_EVENTS = """
raw AS (
  SELECT event_id AS seq, ts AS arrival_ts, 'product-' || user_id AS product_id,
         event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
kinds AS (
  SELECT *, CASE WHEN event_type = 'signup' THEN 'P'
                 WHEN event_type = 'error' AND k < 5 THEN 'D'
                 WHEN event_type = 'error' THEN 'P'
                 WHEN event_type = 'purchase' THEN 'R'
                 ELSE 'S' END AS kind
  FROM raw),
ev AS (
  SELECT seq, arrival_ts, product_id, kind, arrival_ts - to_hours(k) AS updated_at,
         CASE WHEN kind = 'P' THEN 'Product ' || k END AS name,
         CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS brand,
         CASE WHEN kind = 'R' THEN CAST(value AS DECIMAL(18,2)) END AS price,
         CASE WHEN kind = 'R' THEN
           CASE k % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END END AS currency,
         CASE WHEN kind = 'S' THEN 'warehouse-' || (k % 3) END AS warehouse_id,
         CASE WHEN kind = 'S' THEN (k // 3) % 3 END AS quantity
  FROM kinds)"""

_WITH_TABLE = """
base AS (SELECT * FROM ev),
ev_all AS (
  SELECT * FROM base
  UNION ALL BY NAME
  SELECT -1 AS seq, TIMESTAMP '2000-01-01' AS arrival_ts, 'product-' || p_partkey AS product_id,
         'P' AS kind, TIMESTAMP '2000-01-01' AS updated_at, p_name AS name,
         p_type AS category, p_brand AS brand
  FROM part)"""


def _completeness(name: str, price: str, total: str) -> str:
    present = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in (name, price, total))
    return f"ROUND(CAST({present} AS DOUBLE) / 3.0, 6)"


_STOCK_TEXT = (
    "CONCAT_WS(',', 'warehouse-0=' || w0, 'warehouse-1=' || w1, 'warehouse-2=' || w2)"
)

def _joins(source: str = "ev") -> str:
    """Both joins without expiry: ``jn`` has one row per event."""
    return f"""
ep AS (
  SELECT *, SUM(CASE WHEN kind = 'D' THEN 1 ELSE 0 END)
              OVER (PARTITION BY product_id ORDER BY seq) AS epoch
  FROM {source}),
newest AS (
  SELECT *, MAX(updated_at) OVER (PARTITION BY product_id, epoch, kind ORDER BY seq
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS stored,
         LAG(quantity) OVER (PARTITION BY product_id, kind, warehouse_id ORDER BY seq) AS replaced
  FROM ep),
ac AS (
  SELECT *, CASE kind WHEN 'S' THEN TRUE WHEN 'D' THEN FALSE
                 ELSE stored IS NULL OR updated_at > stored END AS accepted
  FROM newest),
one AS (
  SELECT *,
    LAST_VALUE(CASE WHEN kind = 'P' AND accepted THEN
        {{'name': name, 'category': category, 'brand': brand, 'at': updated_at}} END IGNORE NULLS)
      OVER (PARTITION BY product_id, epoch ORDER BY seq) AS product,
    LAST_VALUE(CASE WHEN kind = 'R' AND accepted THEN
        {{'price': price, 'currency': currency, 'at': updated_at}} END IGNORE NULLS)
      OVER (PARTITION BY product_id, epoch ORDER BY seq) AS offer,
    SUM(CASE WHEN kind = 'S' THEN quantity - COALESCE(replaced, 0) END)
      OVER (PARTITION BY product_id ORDER BY seq) AS total,
    MAX(CASE WHEN kind = 'S' THEN date_trunc('milliseconds', updated_at) END)
      OVER (PARTITION BY product_id ORDER BY seq) AS stock_at,
    LAST_VALUE(CASE WHEN warehouse_id = 'warehouse-0' THEN quantity END IGNORE NULLS)
      OVER (PARTITION BY product_id ORDER BY seq) AS w0,
    LAST_VALUE(CASE WHEN warehouse_id = 'warehouse-1' THEN quantity END IGNORE NULLS)
      OVER (PARTITION BY product_id ORDER BY seq) AS w1,
    LAST_VALUE(CASE WHEN warehouse_id = 'warehouse-2' THEN quantity END IGNORE NULLS)
      OVER (PARTITION BY product_id ORDER BY seq) AS w2
  FROM ac),
two AS (
  SELECT *,
    CASE kind WHEN 'P' THEN offer IS NOT NULL WHEN 'R' THEN product IS NOT NULL END AS hit,
    LAST_VALUE(CASE WHEN kind IN ('P', 'R') AND accepted THEN
        {{'product': product, 'offer': offer}} END IGNORE NULLS)
      OVER (PARTITION BY product_id ORDER BY seq) AS pair
  FROM one),
jn AS (
  SELECT seq, arrival_ts, product_id, kind, epoch, accepted, hit, updated_at,
    warehouse_id, quantity, replaced, product, offer,
    pair.product.name AS name, pair.product.category AS category, pair.product.brand AS brand,
    pair.offer.price AS price, pair.offer.currency AS currency,
    pair.product.at AS last_product_update, pair.offer.at AS last_price_update,
    CAST(total AS BIGINT) AS total_stock, stock_at AS last_stock_update,
    {_STOCK_TEXT} AS stock,
    {_completeness('pair.product.name', 'pair.offer.price', 'total')} AS completeness
  FROM two)"""


_SENT = """
made AS (SELECT * FROM jn WHERE accepted),
judged AS (
  SELECT *, {c} IS NOT DISTINCT FROM LAG({c}) OVER (PARTITION BY product_id ORDER BY seq)
       AS unchanged
  FROM (SELECT *, ROW(name, category, brand, price, currency, total_stock, last_product_update,
                      last_price_update, last_stock_update, stock, completeness) AS content
        FROM made)),
sent AS (SELECT * FROM judged WHERE NOT unchanged)""".format(c="content")

_INDEX = """
idx AS (
  SELECT * FROM sent
  QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY seq DESC) = 1)"""

_PAIR = "name, CAST(price AS DOUBLE) AS price, currency, last_product_update, last_price_update"
_DOC = f"{_PAIR}, total_stock, last_stock_update, completeness"


def _sql(*ctes: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{','.join(ctes)}\n{select}"


def _joined(select: str) -> str:
    return _sql(_EVENTS, _joins(), select=select)


def _deduped(select: str) -> str:
    return _sql(_EVENTS, _joins(), _SENT, select=select)


def _indexed(select: str) -> str:
    return _sql(_EVENTS, _joins(), _SENT, _INDEX, select=select)


# --------------------------------------------------------- state that expires


def _life(pair: bool, stock: bool, sent: bool) -> str:
    """One event per product and step; a due time of null never comes."""

    def due(on: bool) -> str:
        return "arrival_ts + INTERVAL 24 HOUR" if on else "CAST(NULL AS TIMESTAMP)"

    return f"""
numbered AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY seq) AS i FROM ev),
life AS (
  SELECT product_id, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS seq,
    CAST(NULL AS VARCHAR) AS kind, CAST(NULL AS TIMESTAMP) AS arrival_ts,
    CAST(NULL AS VARCHAR) AS outcome, CAST(NULL AS BOOLEAN) AS hit,
    CAST(NULL AS VARCHAR) AS p_name, CAST(NULL AS TIMESTAMP) AS p_at,
    CAST(NULL AS DECIMAL(18,2)) AS r_price, CAST(NULL AS VARCHAR) AS r_cur,
    CAST(NULL AS TIMESTAMP) AS r_at, CAST(NULL AS TIMESTAMP) AS due1,
    CAST(NULL AS VARCHAR) AS h_name, CAST(NULL AS TIMESTAMP) AS h_p_at,
    CAST(NULL AS DECIMAL(18,2)) AS h_price, CAST(NULL AS VARCHAR) AS h_cur,
    CAST(NULL AS TIMESTAMP) AS h_r_at,
    CAST(NULL AS INTEGER) AS w0, CAST(NULL AS INTEGER) AS w1, CAST(NULL AS INTEGER) AS w2,
    CAST(NULL AS TIMESTAMP) AS s_at, CAST(NULL AS TIMESTAMP) AS due2,
    CAST(NULL AS VARCHAR) AS content, CAST(NULL AS TIMESTAMP) AS due3
  FROM (SELECT DISTINCT product_id FROM ev)
  UNION ALL
  SELECT product_id, i, seq, kind, arrival_ts,
    CASE WHEN kind = 'D' THEN 'deleted' WHEN NOT ok THEN 'stale'
         WHEN doc IS NOT DISTINCT FROM content THEN 'suppressed' ELSE 'emitted' END,
    hit, p_name, p_at, r_price, r_cur, r_at, due1, h_name, h_p_at, h_price, h_cur, h_r_at,
    w0, w1, w2, s_at, due2,
    CASE WHEN ok THEN doc ELSE content END,
    CASE WHEN ok AND doc IS DISTINCT FROM content THEN {due(sent)} ELSE due3 END
  FROM (
    SELECT *, CONCAT_WS('|', COALESCE(h_name, '-'), COALESCE(CAST(h_p_at AS VARCHAR), '-'),
        COALESCE(CAST(h_price AS VARCHAR), '-'), COALESCE(h_cur, '-'),
        COALESCE(CAST(h_r_at AS VARCHAR), '-'), COALESCE(CAST(w0 AS VARCHAR), '-'),
        COALESCE(CAST(w1 AS VARCHAR), '-'), COALESCE(CAST(w2 AS VARCHAR), '-'),
        COALESCE(CAST(s_at AS VARCHAR), '-')) AS doc
    FROM (
      SELECT product_id, i, seq, kind, arrival_ts, ok,
        CASE WHEN ok AND kind = 'P' THEN r_at IS NOT NULL
             WHEN ok AND kind = 'R' THEN p_at IS NOT NULL END AS hit,
        p_name, p_at, r_price, r_cur, r_at, content, due3,
        CASE WHEN kind = 'D' THEN NULL WHEN ok AND kind <> 'S' THEN {due(pair)} ELSE due1 END AS due1,
        CASE WHEN ok AND kind <> 'S' THEN p_name ELSE h_name END AS h_name,
        CASE WHEN ok AND kind <> 'S' THEN p_at ELSE h_p_at END AS h_p_at,
        CASE WHEN ok AND kind <> 'S' THEN r_price ELSE h_price END AS h_price,
        CASE WHEN ok AND kind <> 'S' THEN r_cur ELSE h_cur END AS h_cur,
        CASE WHEN ok AND kind <> 'S' THEN r_at ELSE h_r_at END AS h_r_at,
        CASE WHEN warehouse_id = 'warehouse-0' THEN quantity ELSE w0 END AS w0,
        CASE WHEN warehouse_id = 'warehouse-1' THEN quantity ELSE w1 END AS w1,
        CASE WHEN warehouse_id = 'warehouse-2' THEN quantity ELSE w2 END AS w2,
        CASE WHEN kind = 'S' AND (s_at IS NULL OR date_trunc('milliseconds', updated_at) > s_at)
             THEN date_trunc('milliseconds', updated_at) ELSE s_at END AS s_at,
        CASE WHEN ok THEN {due(stock)} ELSE due2 END AS due2
      FROM (
        SELECT product_id, i, seq, kind, arrival_ts, updated_at, warehouse_id, quantity, ok,
          CASE WHEN kind = 'D' THEN NULL WHEN ok AND kind = 'P' THEN name ELSE p_name END AS p_name,
          CASE WHEN kind = 'D' THEN NULL WHEN ok AND kind = 'P' THEN updated_at ELSE p_at END AS p_at,
          CASE WHEN kind = 'D' THEN NULL WHEN ok AND kind = 'R' THEN price ELSE r_price END AS r_price,
          CASE WHEN kind = 'D' THEN NULL WHEN ok AND kind = 'R' THEN currency ELSE r_cur END AS r_cur,
          CASE WHEN kind = 'D' THEN NULL WHEN ok AND kind = 'R' THEN updated_at ELSE r_at END AS r_at,
          due1, h_name, h_p_at, h_price, h_cur, h_r_at, w0, w1, w2, s_at, due2, content, due3
        FROM (
          SELECT *, CASE kind WHEN 'S' THEN TRUE WHEN 'D' THEN FALSE
                         WHEN 'P' THEN p_at IS NULL OR updated_at > p_at
                         ELSE r_at IS NULL OR updated_at > r_at END AS ok
          FROM (
            SELECT n.product_id, n.i, n.seq, n.kind, n.arrival_ts, n.updated_at, n.name, n.price,
              n.currency, n.warehouse_id, n.quantity,
              CASE WHEN x1 THEN NULL ELSE p_name END AS p_name,
              CASE WHEN x1 THEN NULL ELSE p_at END AS p_at,
              CASE WHEN x1 THEN NULL ELSE r_price END AS r_price,
              CASE WHEN x1 THEN NULL ELSE r_cur END AS r_cur,
              CASE WHEN x1 THEN NULL ELSE r_at END AS r_at,
              CASE WHEN x1 THEN NULL ELSE due1 END AS due1,
              CASE WHEN x2 THEN NULL ELSE h_name END AS h_name,
              CASE WHEN x2 THEN NULL ELSE h_p_at END AS h_p_at,
              CASE WHEN x2 THEN NULL ELSE h_price END AS h_price,
              CASE WHEN x2 THEN NULL ELSE h_cur END AS h_cur,
              CASE WHEN x2 THEN NULL ELSE h_r_at END AS h_r_at,
              CASE WHEN x2 THEN NULL ELSE w0 END AS w0,
              CASE WHEN x2 THEN NULL ELSE w1 END AS w1,
              CASE WHEN x2 THEN NULL ELSE w2 END AS w2,
              CASE WHEN x2 THEN NULL ELSE s_at END AS s_at,
              CASE WHEN x2 THEN NULL ELSE due2 END AS due2,
              CASE WHEN x3 THEN NULL ELSE content END AS content,
              CASE WHEN x3 THEN NULL ELSE due3 END AS due3
            FROM (
              SELECT l.product_id AS key, l.i AS done, l.p_name, l.p_at, l.r_price, l.r_cur, l.r_at,
                l.due1, l.h_name, l.h_p_at, l.h_price, l.h_cur, l.h_r_at, l.w0, l.w1, l.w2, l.s_at,
                l.due2, l.content, l.due3, m.arrival_ts AS now_at,
                COALESCE(m.arrival_ts >= l.due1, FALSE) AS x1,
                COALESCE(m.arrival_ts >= l.due2, FALSE) AS x2,
                COALESCE(m.arrival_ts >= l.due3, FALSE) AS x3
              FROM life l JOIN numbered m ON m.product_id = l.product_id AND m.i = l.i + 1) s
            JOIN numbered n ON n.product_id = s.key AND n.i = s.done + 1)))))),
steps AS (
  SELECT seq, product_id, kind, arrival_ts, outcome, hit,
    h_name AS name, h_price AS price, h_cur AS currency,
    h_p_at AS last_product_update, h_r_at AS last_price_update,
    CASE WHEN w0 IS NULL AND w1 IS NULL AND w2 IS NULL THEN NULL
         ELSE CAST(COALESCE(w0, 0) + COALESCE(w1, 0) + COALESCE(w2, 0) AS BIGINT) END AS total_stock,
    s_at AS last_stock_update, w0, w1, w2, {_STOCK_TEXT} AS stock
  FROM life WHERE i > 0),
docs AS (
  SELECT *, {_completeness('name', 'price', 'total_stock')} AS completeness
  FROM steps WHERE outcome IN ('emitted', 'suppressed'))"""


def _expiring(select: str, pair: bool = False, stock: bool = False, sent: bool = False) -> str:
    return _sql(_EVENTS, _life(pair, stock, sent), select=select, recursive=True)


# -------------------------------------------------------------------- messages

_MESSAGE_EVENTS = """
src AS (
  SELECT event_id AS seq, ts AS arrival_ts, 'product-' || user_id AS pid,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount, event_id % 20 AS m
  FROM events)"""

_ISO = "'%Y-%m-%dT%H:%M:%S.%fZ'"


def _time(future: int, near: int) -> str:
    return (
        f"CASE m WHEN {future} THEN arrival_ts + INTERVAL 120 SECOND"
        f" WHEN {near} THEN arrival_ts + INTERVAL 30 SECOND"
        " ELSE arrival_ts - to_hours(k) END"
    )


def _iso(at: str) -> str:
    return f"strftime({at}, {_ISO})"


def _texts(name: str, good: str) -> str:
    return f"""
{name} AS (
  SELECT seq, arrival_ts, CASE WHEN json_valid(value) THEN value END AS j
  FROM (SELECT seq, arrival_ts,
          CASE m WHEN 0 THEN '{{{{not json}}}}' WHEN 1 THEN '' ELSE {good} END AS value
        FROM src))"""


_CDC_ROW = f"""('{{"product_id":"' || CASE m WHEN 6 THEN '  ' ELSE pid END || '","name":'
  || CASE m WHEN 7 THEN 'null' ELSE '"Product ' || k || '"' END
  || ',"category":"category-' || (k % 6) || '","brand":null,"updated_at":'
  || CASE m WHEN 8 THEN '0' WHEN 9 THEN '"' || {_iso('arrival_ts')} || '"'
       ELSE CAST(epoch_us({_time(10, 11)}) // 1000 AS VARCHAR) END
  || ',"stray":[1,2]}}')"""

_CDC_TEXTS = _texts(
    "cdc_text",
    f"""'{{' || CASE WHEN m = 2 THEN '"op":" ",' WHEN m IN (4, 5) THEN '"op":"d",'
       WHEN m = 12 THEN '' WHEN m = 13 THEN '"op":"r",' ELSE '"op":"u",' END
  || '"before":' || CASE WHEN m = 4 THEN {_CDC_ROW} ELSE 'null' END
  || ',"after":' || CASE WHEN m IN (3, 4, 5) THEN 'null' ELSE {_CDC_ROW} END || ',"ts_ms":1}}'""",
)

_CDC_PARSED = """
cdc_row AS (
  SELECT seq, arrival_ts, j, json_extract_string(j, '$.op') AS operation,
    CASE WHEN json_extract_string(j, '$.op') = 'd' THEN json_extract(j, '$.before')
         ELSE json_extract(j, '$.after') END AS r
  FROM cdc_text),
cdc_field AS (
  SELECT *, json_extract_string(r, '$.product_id') AS product_id,
    COALESCE(TRY_CAST(json_extract_string(r, '$.updated_at') AS BIGINT), 0) AS ms
  FROM cdc_row),
cdc AS (
  SELECT seq, product_id, operation,
    COALESCE(json_extract_string(r, '$.name'), '') AS name,
    json_extract_string(r, '$.category') AS category,
    json_extract_string(r, '$.brand') AS brand,
    json_extract_string(r, '$.description') AS description,
    CASE WHEN ms > 0 THEN make_timestamp(ms * 1000) ELSE arrival_ts END AS updated_at,
    CASE WHEN j IS NULL THEN 'malformed'
         WHEN operation IS NULL OR trim(operation) = '' OR r IS NULL OR json_type(r) = 'NULL'
           THEN 'no_row'
         WHEN product_id IS NULL OR trim(product_id) = '' THEN 'blank_product_id'
         WHEN ms > epoch_us(arrival_ts) // 1000 + 60000 THEN 'future_timestamp' END AS reject_reason
  FROM cdc_field)"""

_PRICE_TEXTS = _texts(
    "price_text",
    f"""'{{"productId":"' || CASE m WHEN 2 THEN '   ' WHEN 6 THEN '' ELSE pid END || '"'
  || CASE m WHEN 3 THEN '' ELSE ',"price":' || amount END || ',"currency":"'
  || CASE k % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END
  || '","updatedAt":"' || {_iso(_time(4, 5))} || '","source":"feed"}}'""",
)


def _reason(required: str, extra: str = "") -> str:
    return f"""CASE WHEN j IS NULL THEN 'malformed' WHEN {required} THEN 'missing_field'
         WHEN trim(product_id) = '' THEN 'blank_product_id' {extra}
         WHEN epoch_us(updated_at) // 1000 > epoch_us(arrival_ts) // 1000 + 60000 THEN 'future_timestamp'
    END AS reject_reason"""


_PRICE_PARSED = f"""
prices AS (
  SELECT *, {_reason('price IS NULL OR product_id IS NULL OR updated_at IS NULL OR currency IS NULL')}
  FROM (SELECT seq, arrival_ts, j, json_extract_string(j, '$.productId') AS product_id,
          CAST(json_extract_string(j, '$.price') AS DECIMAL(18,2)) AS price,
          json_extract_string(j, '$.currency') AS currency,
          strptime(json_extract_string(j, '$.updatedAt'), {_ISO}) AS updated_at
        FROM price_text))"""

_STOCK_TEXTS = _texts(
    "stock_text",
    f"""'{{"productId":"' || CASE m WHEN 2 THEN '' ELSE pid END || '","warehouseId":"'
  || CASE m WHEN 3 THEN ' ' ELSE 'warehouse-' || (k % 3) END || '"'
  || CASE m WHEN 4 THEN '' ELSE ',"quantity":' || k END
  || ',"updatedAt":"' || {_iso(_time(5, 6))} || '"}}'""",
)

_STOCK_PARSED = f"""
stocks AS (
  SELECT *, {_reason('quantity IS NULL OR product_id IS NULL OR updated_at IS NULL OR warehouse_id IS NULL',
                     "WHEN trim(warehouse_id) = '' THEN 'blank_warehouse_id'")}
  FROM (SELECT seq, arrival_ts, j, json_extract_string(j, '$.productId') AS product_id,
          json_extract_string(j, '$.warehouseId') AS warehouse_id,
          CAST(json_extract_string(j, '$.quantity') AS INTEGER) AS quantity,
          strptime(json_extract_string(j, '$.updatedAt'), {_ISO}) AS updated_at
        FROM stock_text))"""

_PRODUCT_TEXTS = _texts(
    "product_text",
    f"""'{{"productId":"' || CASE m WHEN 3 THEN '' ELSE pid END || '"'
  || CASE m WHEN 2 THEN '' ELSE ',"name":"Product ' || k || '"' END
  || ',"brand":"brand-' || (k % 5) || '","updatedAt":"' || {_iso(_time(4, 5))}
  || '","operation":"' || CASE m WHEN 6 THEN 'd' ELSE 'u' END || '"}}'""",
)

# --------------------------------------------------------------------- queries

# Parsed messages as one stream: three inputs share the event's number, so each has its place in three.
_MESSAGE_CHANGES = """
parsed AS (
  SELECT seq * 3 AS n, seq, product_id, CASE operation WHEN 'd' THEN 'D' ELSE 'P' END AS kind, updated_at,
         name, category, brand FROM cdc WHERE reject_reason IS NULL
  UNION ALL BY NAME
  SELECT seq * 3 + 1 AS n, seq, product_id, 'R' AS kind, updated_at, CAST(price AS DECIMAL(18,2)) AS price, currency
  FROM prices WHERE reject_reason IS NULL
  UNION ALL BY NAME
  SELECT seq * 3 + 2 AS n, seq, product_id, 'S' AS kind, updated_at, warehouse_id, CAST(quantity AS INTEGER) AS quantity
  FROM stocks WHERE reject_reason IS NULL),
ev AS (
  SELECT p.* EXCLUDE (n, seq), n AS seq, s.arrival_ts FROM parsed p JOIN src s ON s.seq = p.seq)"""

_RATE = "COUNT(*) AS events, ROUND(COUNT(*) / 60.0, 6) AS per_second"
_COUNTED = """
counted AS (
  SELECT *, CASE kind WHEN 'P' THEN 'products' WHEN 'R' THEN 'prices' ELSE 'stock' END AS stream
  FROM judged)"""
_GAUGE = """
gauge AS (
  SELECT *, GREATEST(0, (epoch_us(arrival_ts)
      - epoch_us(GREATEST(last_price_update, last_stock_update))) // 1000) AS latency_ms
  FROM sent WHERE last_price_update IS NOT NULL OR last_stock_update IS NOT NULL)"""
_READ = (
    "product_id, name, CAST(price AS DOUBLE) AS price, total_stock, completeness,"
    " arrival_ts AS indexed_at,"
    " last_product_update, last_price_update, last_stock_update"
)


def _counted(select: str) -> str:
    return _sql(_EVENTS, _joins(), _SENT, _COUNTED, select=select)


def _latency(pick: str, test: str) -> str:
    latency = (
        f"(epoch_us(arrival_ts) - epoch_us({pick}(last_product_update, last_price_update,"
        " last_stock_update))) // 1000"
    )
    return _indexed(
        f"SELECT product_id, {latency} AS latency_ms, {latency} {test} AS within_limit FROM idx"
    )


# crc32 of a text, bit by bit.
_CRC = """xor(list_reduce(flatten(list_transform(range(length(product_id)), lambda i:
  [ascii(substr(product_id, i + 1, 1)), -1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])),
  lambda z, b: CASE WHEN b >= 0 THEN xor(z, b) ELSE xor(z >> 1, 3988292384 * (z & 1)) END, 4294967295::BIGINT),
  4294967295::BIGINT)"""

ORACLES: dict[str, str] = {
    "cdc_parse": _sql(
        _MESSAGE_EVENTS, _CDC_TEXTS, _CDC_PARSED,
        select="SELECT seq, product_id, name, category, brand, description, updated_at, operation"
               " FROM cdc WHERE reject_reason IS NULL",
    ),
    "price_parse": _sql(
        _MESSAGE_EVENTS, _PRICE_TEXTS, _PRICE_PARSED,
        select="SELECT seq, product_id, CAST(price AS DOUBLE) AS price, currency, updated_at"
               " FROM prices WHERE reject_reason IS NULL",
    ),
    "stock_parse": _sql(
        _MESSAGE_EVENTS, _STOCK_TEXTS, _STOCK_PARSED,
        select="SELECT seq, product_id, warehouse_id, quantity, updated_at"
               " FROM stocks WHERE reject_reason IS NULL",
    ),
    "product_json_parse": _sql(
        _MESSAGE_EVENTS, _PRODUCT_TEXTS,
        select=f"""
SELECT seq, json_extract_string(j, '$.productId') AS product_id,
  json_extract_string(j, '$.name') AS name, json_extract_string(j, '$.brand') AS brand,
  strptime(json_extract_string(j, '$.updatedAt'), {_ISO}) AS updated_at,
  json_extract_string(j, '$.operation') AS operation
FROM product_text WHERE j IS NOT NULL AND json_extract_string(j, '$.name') IS NOT NULL""",
    ),
    "parse_rejects": _sql(
        _MESSAGE_EVENTS, _CDC_TEXTS, _CDC_PARSED, _PRICE_TEXTS, _PRICE_PARSED,
        _STOCK_TEXTS, _STOCK_PARSED,
        select="""
SELECT stream, reject_reason, COUNT(*) AS n FROM (
  SELECT 'products' AS stream, reject_reason FROM cdc
  UNION ALL SELECT 'prices', reject_reason FROM prices
  UNION ALL SELECT 'stock', reject_reason FROM stocks)
WHERE reject_reason IS NOT NULL GROUP BY ALL""",
    ),
    "future_guard": _sql(
        _EVENTS,
        select="""
SELECT seq, product_id, 59998 + seq % 5 AS ahead_ms,
  epoch_us(arrival_ts + to_milliseconds(59998 + seq % 5)) // 1000 > epoch_us(arrival_ts) // 1000 + 60000 AS rejected
FROM ev""",
    ),
    "snapshot_bootstrap": _sql(
        _EVENTS, _WITH_TABLE, _joins("ev_all"),
        select=f"""
SELECT product_id, {_PAIR}, category, brand, total_stock, completeness, arrival_ts AS indexed_at
FROM jn WHERE accepted QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY seq DESC) = 1""",
    ),
    "stale_filter": _joined(
        "SELECT seq, product_id, kind, updated_at, accepted FROM jn WHERE kind IN ('P', 'R')"
    ),
    "delete_epochs": _joined(
        "SELECT seq, product_id, kind, CAST(epoch AS BIGINT) AS epoch, accepted"
        " FROM jn WHERE kind <> 'S'"
    ),
    "product_price_changelog": _joined(
        f"SELECT seq, product_id, {_PAIR}, {_completeness('name', 'price', 'NULL')} AS completeness,"
        " hit FROM jn WHERE accepted AND kind IN ('P', 'R')"
    ),
    "product_price_latest": _joined("""
SELECT product_id, product.name AS name, CAST(offer.price AS DOUBLE) AS price,
  offer.currency AS currency, product.at AS last_product_update, offer.at AS last_price_update
FROM (SELECT * FROM jn WHERE kind <> 'S'
      QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY seq DESC) = 1)
WHERE product IS NOT NULL OR offer IS NOT NULL"""),
    "enriched_changelog": _joined(
        f"SELECT seq, product_id, {_DOC}, stock, arrival_ts AS indexed_at FROM jn WHERE accepted"
    ),
    "enriched_latest": _joined(
        f"SELECT product_id, {_DOC}, stock, arrival_ts AS indexed_at FROM jn WHERE accepted"
        " QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY seq DESC) = 1"
    ),
    "join_completeness": _joined("""
SELECT hits, misses, ROUND(ratio, 6) AS ratio,
  CASE WHEN ratio >= 0.95 THEN 'green' WHEN ratio >= 0.9 THEN 'yellow' ELSE 'red' END AS band
FROM (SELECT hits, misses, hits / CAST(hits + misses AS DOUBLE) AS ratio
      FROM (SELECT COUNT(*) FILTER (hit) AS hits, COUNT(*) FILTER (NOT hit) AS misses
            FROM jn WHERE accepted AND kind IN ('P', 'R')))"""),
    "stock_latest": _sql(
        _EVENTS,
        select="SELECT product_id, warehouse_id, quantity FROM ev WHERE kind = 'S' QUALIFY"
               " ROW_NUMBER() OVER (PARTITION BY product_id, warehouse_id ORDER BY seq DESC) = 1",
    ),
    "stock_map": _joined(
        "SELECT product_id, stock FROM jn WHERE kind = 'S' QUALIFY"
        " ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY seq DESC) = 1"
    ),
    "stock_totals": _sql(
        _EVENTS,
        select="""
SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS total_stock, MAX(stock_at) AS last_stock_update
FROM (SELECT product_id, warehouse_id, arg_max(quantity, seq) AS quantity,
        MAX(date_trunc('milliseconds', updated_at)) AS stock_at
      FROM ev WHERE kind = 'S' GROUP BY ALL)
GROUP BY product_id""",
    ),
    "stock_running": _joined(
        "SELECT seq, product_id, warehouse_id, quantity, replaced, total_stock, last_stock_update"
        " FROM jn WHERE kind = 'S'"
    ),
    "dedup_changelog": _deduped(
        f"SELECT seq, product_id, {_DOC}, arrival_ts AS indexed_at FROM sent"
    ),
    "dedup_stats": _counted(
        "SELECT stream, COUNT(*) FILTER (unchanged) AS suppressed,"
        " COUNT(*) FILTER (NOT unchanged) AS emitted FROM counted GROUP BY stream"
    ),
    "doc_hash_groups": _deduped("""
SELECT times_sent, COUNT(*) AS contents
FROM (SELECT product_id, content, COUNT(*) AS times_sent FROM sent GROUP BY ALL) GROUP BY times_sent"""),
    "ttl_stage1": _expiring(
        f"SELECT seq, product_id, {_PAIR}, hit FROM docs WHERE kind IN ('P', 'R')", pair=True
    ),
    "ttl_stage2": _expiring(
        f"SELECT seq, product_id, {_PAIR}, total_stock, last_stock_update, stock FROM docs",
        stock=True,
    ),
    "ttl_dedup": _expiring("SELECT seq, product_id, kind, outcome FROM docs", sent=True),
    "ttl_full_pipeline": _expiring(
        f"SELECT seq, product_id, {_DOC}, stock, arrival_ts AS indexed_at"
        " FROM docs WHERE outcome = 'emitted'",
        pair=True, stock=True, sent=True,
    ),
    "ttl_outcomes": _expiring(
        "SELECT kind, outcome, COUNT(*) AS events, COUNT(*) FILTER (hit) AS hits"
        " FROM steps GROUP BY kind, outcome",
        pair=True, stock=True, sent=True,
    ),
    "index_upsert": _indexed(
        f"SELECT product_id, {_DOC}, stock, arrival_ts AS indexed_at FROM idx"
    ),
    "index_table": _indexed(f"SELECT product_id, {_DOC}, stock, arrival_ts AS indexed_at FROM idx"),
    "index_table_lookup": _indexed(f"SELECT {_READ} FROM idx WHERE product_id = 'product-7'"),
    "index_requests": _indexed(f"""
SELECT bucket, request, COUNT(*) AS updates, MIN(product_id) AS first_id, MAX(product_id) AS last_id,
       CAST(2 * COUNT(*) AS INTEGER) AS lines
FROM (SELECT *, CAST((ROW_NUMBER() OVER (PARTITION BY bucket ORDER BY product_id) - 1) // 20 AS INTEGER) AS request
      FROM (SELECT product_id, CAST({_CRC} % 4 AS INTEGER) AS bucket FROM idx))
GROUP BY bucket, request"""),
    "pipeline_from_messages": _sql(
        _MESSAGE_EVENTS, _CDC_TEXTS, _CDC_PARSED, _PRICE_TEXTS, _PRICE_PARSED, _STOCK_TEXTS, _STOCK_PARSED,
        _MESSAGE_CHANGES, _joins(), _SENT, _INDEX,
        select=f"SELECT product_id, category, brand, {_DOC}, stock, arrival_ts AS indexed_at FROM idx",
    ),
    "index_upsert_ttl": _expiring(
        f"""
SELECT product_id, {_DOC}, {_STOCK_TEXT} AS stock, indexed_at FROM (
  SELECT product_id, seq, arrival_ts AS indexed_at, {_DOC},
    LAST_VALUE(w0 IGNORE NULLS) OVER (PARTITION BY product_id ORDER BY seq) AS w0,
    LAST_VALUE(w1 IGNORE NULLS) OVER (PARTITION BY product_id ORDER BY seq) AS w1,
    LAST_VALUE(w2 IGNORE NULLS) OVER (PARTITION BY product_id ORDER BY seq) AS w2
  FROM docs WHERE outcome = 'emitted')
QUALIFY ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY seq DESC) = 1""",
        pair=True, stock=True, sent=True,
    ),
    "index_typed": _indexed(
        "SELECT product_id, name, CAST(price AS DOUBLE) AS price, currency, CAST(total_stock AS INTEGER) AS total_stock,"
        " ROUND(CAST(CAST(completeness AS FLOAT) AS DOUBLE), 6) AS completeness,"
        " arrival_ts AS indexed_at FROM idx"
    ),
    "doc_json": _indexed(f"""
SELECT product_id, '{{"productId":' || to_json(product_id)
  || ',"name":' || COALESCE(CAST(to_json(name) AS VARCHAR), 'null')
  || ',"category":null,"brand":null,"description":null'
  || ',"price":' || COALESCE(
       CASE WHEN price = trunc(price) THEN CAST(CAST(price AS BIGINT) AS VARCHAR)
            ELSE rtrim(CAST(price AS VARCHAR), '0') END, 'null')
  || ',"currency":' || COALESCE(CAST(to_json(currency) AS VARCHAR), 'null')
  || ',"totalStock":' || COALESCE(CAST(total_stock AS VARCHAR), 'null')
  || ',"stockByWarehouse":{{' || regexp_replace(stock, '([^,=]+)=', '"\\1":', 'g') || '}}'
  || ',"lastProductUpdate":' || COALESCE('"' || {_iso('last_product_update')} || '"', 'null')
  || ',"lastPriceUpdate":' || COALESCE('"' || {_iso('last_price_update')} || '"', 'null')
  || ',"lastStockUpdate":' || COALESCE('"' || {_iso('last_stock_update')} || '"', 'null')
  || ',"completeness":' || CAST(ROUND(completeness * 3) / 3.0 AS VARCHAR)
  || ',"indexedAt":"' || {_iso('arrival_ts')} || '"}}' AS json
FROM idx"""),
    "doc_lookup": _indexed(f"SELECT {_READ} FROM idx WHERE product_id = 'product-7'"),
    "doc_count": _indexed("SELECT COUNT(*) AS documents FROM idx"),
    "docs_complete": _indexed(f"SELECT {_READ} FROM idx WHERE completeness >= 1.0"),
    "doc_sample": _indexed(f"SELECT {_READ} FROM idx ORDER BY product_id LIMIT 5"),
    "event_counts": _counted("SELECT stream, COUNT(*) AS events FROM counted GROUP BY stream"),
    "events_rate": _counted(
        f"SELECT date_trunc('minute', arrival_ts) AS minute, stream, {_RATE}"
        " FROM counted GROUP BY ALL"
    ),
    "events_rate_total": _counted(
        f"SELECT date_trunc('minute', arrival_ts) AS minute, {_RATE} FROM counted GROUP BY ALL"
    ),
    "events_rate_sliding": _counted(f"""
SELECT time_bucket(INTERVAL 10 SECOND, arrival_ts) - back * INTERVAL 10 SECOND AS minute,
  stream, {_RATE}
FROM (SELECT *, UNNEST([0, 1, 2, 3, 4, 5]) AS back FROM counted) GROUP BY ALL"""),
    "dedup_rate": _counted(
        f"SELECT date_trunc('minute', arrival_ts) AS minute, {_RATE}"
        " FROM counted WHERE unchanged GROUP BY ALL"
    ),
    "completeness_dist": _deduped(
        "SELECT completeness, COUNT(*) AS documents FROM sent GROUP BY completeness"
    ),
    "latency_gauge": _sql(
        _EVENTS, _joins(), _SENT, _GAUGE,
        select="SELECT product_id, arg_max(latency_ms, seq) AS latency_ms FROM gauge GROUP BY product_id",
    ),
    "latency_stats": _sql(
        _EVENTS, _joins(), _SENT, _GAUGE,
        select="SELECT date_trunc('minute', arrival_ts) AS minute,"
               " ROUND(AVG(latency_ms), 3) AS avg_latency_ms, MAX(latency_ms) AS max_latency_ms"
               " FROM gauge GROUP BY 1",
    ),
    "latency_oldest": _latency("LEAST", "<= 30000"),
    "latency_newest": _latency("GREATEST", "< 10000"),
}
