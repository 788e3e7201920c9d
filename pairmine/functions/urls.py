"""URL expressions: resolution against a page, fetchability, asset file names.

They take column names and are written as SQL text: one expression each, with
the parts of a URL computed once in a struct.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = "[a-zA-Z][a-zA-Z0-9+.-]*"
# Schemes whose references may be relative.
_RELATIVE = "('http', 'https', 'ftp', 'file', 'sftp', 'ws', 'wss')"


def _parts(url: str) -> str:
    return rf"""named_struct(
      'scheme', lower(regexp_extract({url}, r'^({_SCHEME}):', 1)),
      'authority', regexp_extract({url}, r'^(?:{_SCHEME}:)?//([^/?#]*)', 1),
      'path', regexp_extract({url}, r'^(?:{_SCHEME}:)?(?://[^/?#]*)?([^?#]*)', 1),
      'query', regexp_extract({url}, r'^[^?#]*\?([^#]*)', 1),
      'fragment', regexp_extract({url}, r'#([\s\S]*)$', 1))"""


def url_parts(url: str) -> Column:
    """Struct of scheme, authority, path, query and fragment; absent parts are empty."""
    return F.expr(_parts(url))


def _assemble(authority: str, path: str, query: str) -> str:
    """Base scheme, authority, path, query and the reference's fragment; empty parts vanish."""
    return rf"""concat(
        if(u.base.scheme = '', '', concat(u.base.scheme, ':')),
        if({authority} = '', '', concat('//', {authority})),
        if({authority} <> '' and {path} <> '' and not startswith({path}, '/'), '/', ''), {path},
        if({query} = '', '', concat('?', {query})),
        if(u.ref.fragment = '', '', concat('#', u.ref.fragment)))"""


def resolve_url(page_url: str, src: str, page_parts: str | None = None) -> Column:
    """Absolute URL of the reference in ``src`` on the page in ``page_url``.

    Takes absolute, ``//host``, ``/root`` and relative references, dot segments,
    query-only and fragment-only references.  It never fails: characters that a
    strict URL parser refuses are kept.  ``page_parts`` names a column that
    already holds the page's ``url_parts``.
    """
    raw = rf"regexp_replace(regexp_replace({src}, r'^[\x00-\x20]+', ''), r'[\t\r\n]', '')"
    urls = rf"""transform(array({raw}), raw -> named_struct('page', {page_url}, 'raw', raw,
        'base', {page_parts or _parts(page_url)}, 'ref', {_parts('raw')}))"""
    # Below the folder of the page; empty segments inside a relative path vanish.
    segments = r"""if(startswith(u.ref.path, '/'), split(u.ref.path, '/', -1),
        split(regexp_replace(concat(regexp_replace(u.base.path, r'[^/]*$', ''), u.ref.path),
          r'(?<=.)/{2,}', '/'), '/', -1))"""
    without_dots = f"""transform(array({segments}), s -> concat(
        aggregate(s, cast(array() as array<string>), (kept, x) -> case x
          when '..' then slice(kept, 1, greatest(size(kept) - 1, 0))
          when '.' then kept else concat(kept, array(x)) end),
        if(element_at(s, -1) in ('.', '..'), array(''), cast(array() as array<string>))))[0]"""
    path = f"transform(array(array_join({without_dots}, '/')), p -> if(p = '', '/', p))[0]"
    joined = f"transform(array({path}), q -> {_assemble('u.base.authority', 'q', 'u.ref.query')})[0]"
    base_query = "if(u.ref.query = '', u.base.query, u.ref.query)"
    return F.expr(rf"""
      case when coalesce({page_url}, '') = '' then {src} else transform({urls}, u -> case
        when u.raw = '' then u.page
        when u.ref.scheme <> '' and (u.ref.scheme <> u.base.scheme or u.ref.scheme not in {_RELATIVE}) then u.raw
        when u.ref.scheme = '' and u.base.scheme <> '' and u.base.scheme not in {_RELATIVE} then u.raw
        when u.ref.authority <> '' then {_assemble('u.ref.authority', 'u.ref.path', 'u.ref.query')}
        when u.ref.path = '' then {_assemble('u.base.authority', 'u.base.path', base_query)}
        else {joined} end)[0] end""")


def is_fetchable(url: Column) -> Column:
    """True for a non-empty http or https URL (lower-case scheme)."""
    return F.coalesce(url.startswith("http://") | url.startswith("https://"), F.lit(False))


def asset_name(url: str) -> Column:
    """File name of a fetched image.

    The last path segment with everything but letters, digits, dot and
    underscore replaced; without a usable segment, ``image_<hash>.jpg``; without
    an extension, ``.jpg``.  The URL's hash goes in front, so that equal
    segments of different URLs do not meet.
    """
    path = rf"regexp_extract({url}, r'^(?:{_SCHEME}:)?(?://[^/?#]*)?([^?#]*)', 1)"
    safe = rf"regexp_replace(regexp_extract({path}, r'([^/]*)$', 1), r'[^\p{{L}}\p{{N}}._]', '_')"
    return F.expr(rf"""
      transform(array(named_struct('hash', sha2({url}, 256), 'name', {safe})), n -> concat(
        n.hash, '_', case
          when n.name = '' or startswith(n.name, '.') then concat('image_', n.hash, '.jpg')
          when not contains(n.name, '.') then concat(n.name, '.jpg')
          else n.name end))[0]""")
