"""Names of datasets."""

from __future__ import annotations

from pathlib import PurePosixPath


def dataset_name(root: str) -> str:
    """A folder's name without its last suffix; of ``scheme://repository/branch/...`` the repository, with the branch unless it is main."""
    scheme, separator, rest = root.partition("://")
    if not separator or scheme == "file":
        return PurePosixPath(rest or root).stem
    repository, _, rest = rest.partition("/")
    branch = rest.partition("/")[0]
    return repository if branch in ("", "main") else f"{repository}_{branch}"
