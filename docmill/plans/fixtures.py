"""Invented payloads of the wire contract."""

from __future__ import annotations

import json


def _envelope(**changes) -> str:
    record = lambda page, row, hindi, common, confidence, raw=None: {
        "source": {"page_number": page, "row_number": row}, "hindi": hindi, "english": {}, "common": common, "raw_record": raw or {}, "confidence": confidence,
    }
    body = {
        "success": True, "http_status": 200, "extractor_version": "v1", "page_from": 3, "page_to": 4, "document_metadata": {},
        "records": [
            record(3, 1, {"name": "Ram Lal", "gender": "पुरुष"}, {"age": 30, "relationship_type": "father", "serial_number": 1, "epic_number": "ABC1234567"}, 0.75),
            record(3, 2, {}, {"age": 200}, 2.5),
            record(4, 1, {"name": " A B  C D "}, {}, "high", {"sno": 7, "is_deleted": True, "roll_format": "municipal_ward", "ward_code": "12"}),
        ],
    }
    return json.dumps(body | changes, ensure_ascii=False)


ENVELOPES = {
    "ok": _envelope(),
    "refused": _envelope(success=False, error={"code": "MODEL_TIMEOUT", "message": "slow"}),
    "refused_final": _envelope(success=False, error={"code": "BAD_FILE"}),
    "server": _envelope(http_status=503),
    "client": _envelope(http_status=404),
    "range": _envelope(page_from=1),
    "version": _envelope(extractor_version=None),
    "no_source": _envelope(records=[{"hindi": {}}]),
    "page": _envelope(records=[{"source": {"page_number": 9, "row_number": 1}}]),
    "not_json": "[1, 2]",
}
