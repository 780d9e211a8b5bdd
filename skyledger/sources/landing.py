"""Landing a download: files by alias, with the checks of archives and pages."""

from __future__ import annotations

import re
import zipfile
from pathlib import Path
from urllib.parse import urljoin

from ..operators.joins import GuardError, safe_name

#: Statuses worth another try; fixed values.
RETRIED = (408, 425, 429)


def worth_retrying(status: int) -> bool:
    return status in RETRIED or 500 <= status < 600


def discovered_url(page: str, base: str, pattern: str) -> str:
    """The first capture of the pattern in an index page, resolved against the page's address."""
    m = re.search(pattern, page)
    if not m:
        raise GuardError("the index page has no link of the pattern")
    return urljoin(base, m[1])


def land_zip(archive: str | Path, entries: dict[str, str], target: str | Path) -> dict[str, str]:
    """Unpacks the named entries as alias files; checksums are verified, a missing entry fails."""
    out = {}
    with zipfile.ZipFile(archive) as z:
        for alias, name in entries.items():
            if name not in z.namelist():
                raise GuardError(f"no entry {name}")
            path = Path(target, safe_name(alias))
            path.parent.mkdir(parents=True, exist_ok=True)
            with z.open(name) as source, path.open("wb") as sink:
                while block := source.read(1 << 20):
                    sink.write(block)
            out[alias] = str(path)
    return out
