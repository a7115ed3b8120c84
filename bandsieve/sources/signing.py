"""Signature version 4 for S3-compatible stores: a public standard, for connectors that fetch without a client library."""

from __future__ import annotations

import hashlib
import hmac
from urllib.parse import quote


def signing_key(secret: str, day: str, region: str, service: str = "s3") -> bytes:
    key = b"AWS4" + secret.encode()
    for part in (day, region, service, "aws4_request"):
        key = hmac.new(key, part.encode(), hashlib.sha256).digest()
    return key


def presign(method: str, host: str, path: str, access: str, secret: str, stamp: str, expires: int = 3600, region: str = "auto", query: dict[str, str] | None = None) -> str:
    """A presigned URL; stamp is the time as YYYYMMDDTHHMMSSZ."""
    scope = f"{stamp[:8]}/{region}/s3/aws4_request"
    params = (query or {}) | {"X-Amz-Algorithm": "AWS4-HMAC-SHA256", "X-Amz-Credential": f"{access}/{scope}", "X-Amz-Date": stamp, "X-Amz-Expires": str(expires), "X-Amz-SignedHeaders": "host"}
    text = "&".join(f"{quote(k, safe='')}={quote(v, safe='')}" for k, v in sorted(params.items()))
    canonical = "\n".join((method, quote(path), text, f"host:{host}", "", "host", "UNSIGNED-PAYLOAD"))
    to_sign = "\n".join(("AWS4-HMAC-SHA256", stamp, scope, hashlib.sha256(canonical.encode()).hexdigest()))
    signature = hmac.new(signing_key(secret, stamp[:8], region), to_sign.encode(), hashlib.sha256).hexdigest()
    return f"https://{host}{quote(path)}?{text}&X-Amz-Signature={signature}"
