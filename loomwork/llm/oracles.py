"""DuckDB twins of the subpackage's queries, where SQL can express them."""

from __future__ import annotations

_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# base32 of a hex digest: five bits at a time from its 160
_BITS = "list_aggregate(list_transform(range(1, 41), lambda i: right('000' || bin(('0x' || substr(sha, i, 1))::INTEGER), 4)), 'string_agg', '')"
_BASE32 = f"list_aggregate(list_transform(range(0, 32), lambda i: substr('{_DIGITS}', 1 + list_sum(list_transform(range(1, 6), lambda j: (substr(bits, 5 * i + j, 1))::INTEGER * (1 << (5 - j))))::INTEGER, 1)), 'string_agg', '')"

_END = "chr(13) || chr(10)"
OP8 = f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS u, coalesce(html, '') AS h FROM pages),
     d AS (SELECT page_id, u, strlen(h)::BIGINT AS payload_bytes, h, sha1(h) AS sha, min(page_id) OVER (PARTITION BY h) AS first_id FROM p),
     b AS (SELECT *, {_BITS} AS bits, page_id <> first_id AS again FROM d),
     r AS (SELECT *, {_BASE32} AS payload_digest FROM b)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_id END AS refers_to,
       sha256(concat_ws({_END}, 'WARC/1.1', 'WARC-Type: ' || CASE WHEN again THEN 'revisit' ELSE 'response' END,
                        'WARC-Record-ID: <urn:page:' || page_id || '>', 'WARC-Date: 1970-01-01T00:00:00Z', 'WARC-Target-URI: ' || u,
                        'WARC-Payload-Digest: sha1:' || payload_digest,
                        CASE WHEN again THEN 'WARC-Refers-To: <urn:page:' || first_id || '>' END,
                        CASE WHEN again THEN 'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest' END,
                        'Content-Type: text/html', 'Content-Length: ' || CASE WHEN again THEN 0 ELSE payload_bytes END,
                        '', CASE WHEN again THEN '' ELSE h END, '', '')) AS record_sha256
FROM r
"""


def oracle_sql() -> dict[str, str]:
    return {"op8_warc": OP8}
