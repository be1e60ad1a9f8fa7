from .audit import audit_append, read_audit
from .lines import compact_lines, publish_lines, published

__all__ = ["audit_append", "compact_lines", "publish_lines", "published", "read_audit"]
