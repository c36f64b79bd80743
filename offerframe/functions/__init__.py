"""Column expressions (JVM-side, codegen-friendly) used by the operators."""

from .codecs import get_bool, is_active, put_bool, snapshot_stamp
from .html import (Selector, clean_html, element_text, select_inner,
                   select_text, title_text, unescape, with_texts)
from .numbers import lenient_number, strict_number
from .text import (base_of_url, is_present, null_if_sentinel, split_after,
                   website_from_url)

__all__ = [
    "Selector", "base_of_url", "clean_html", "element_text", "get_bool",
    "is_active", "is_present", "lenient_number", "null_if_sentinel",
    "put_bool", "select_inner", "with_texts", "select_text",
    "snapshot_stamp", "split_after", "strict_number", "title_text",
    "unescape", "website_from_url",
]
