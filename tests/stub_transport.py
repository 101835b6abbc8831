"""Transports of tests, in place of the network."""

from __future__ import annotations

import json


def list_pages(url, timeout):
    """Three list pages, each but the last with its next link."""
    n = int(url.rpartition("=")[2]) if "=" in url else 1
    link = {"Link": f'<{url.split("?")[0]}?page={n + 1}>; rel="next"'} if n < 3 else {}
    return 200, link, json.dumps([{"name": f"v{n}"}]).encode(), url
