"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from culvert.llm.align_tokens import op13_token_alignment
from culvert.llm.html_text import op7_html_text
from culvert.llm.imatch import op2_imatch
from culvert.llm.jaccard import op4_jaccard_join
from culvert.llm.langid import op10_language_id
from culvert.llm.packing import op8_packing
from culvert.llm.pieces import op3_sentencepiece
from culvert.llm.pii import op1_pii
from culvert.llm.quality import op6_quality_rules
from culvert.llm.simhash_vp import op11_simhash_vp
from culvert.llm.suffix_dedup import op9_suffix_dedup
from culvert.llm.turn_repair import op12_turn_repair
from culvert.llm.warc import op5_warc

QUERIES = {
    "op1_pii": op1_pii,
    "op2_imatch": op2_imatch,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_warc": op5_warc,
    "op6_quality_rules": op6_quality_rules,
    "op7_html_text": op7_html_text,
    "op8_packing": op8_packing,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_language_id": op10_language_id,
    "op11_simhash_vp": op11_simhash_vp,
    "op12_turn_repair": op12_turn_repair,
    "op13_token_alignment": op13_token_alignment,
}

#: The others' rows (hash groups, learned verdicts, tokens, spans by scanning) cannot be expressed in SQL, or not at this size.
ORACLE: dict[str, str] = {
    "op5_warc": """
        WITH sized AS (
            SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        firsts AS (SELECT payload_digest, min(page_id) AS page FROM sized WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT s.page_id, s.url, s.payload_bytes, s.payload_digest,
               CASE WHEN f.page < s.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN f.page < s.page_id THEN f.page END AS refers_to
        FROM sized s LEFT JOIN firsts f ON f.payload_digest = s.payload_digest AND s.payload_bytes >= 100
    """,
}
