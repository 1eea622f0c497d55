"""Values the results depend on: word lists, tag names, prefixes, switches.

All of these are fixed values, kept as plain text.
"""

# Stop words of the term-document matrix.
TERM_STOPWORDS = tuple(
    """
    | =
    i me my myself we our ours ourselves you your yours yourself yourselves
    he him his himself she her hers herself it its itself they them their theirs themselves
    what which who whom this that these those am is are was were be been being
    have has had having do does did doing a an the and but if or because as until while
    of at by for with about against between into through during before after above below
    to from up down in out on off over under again further then once here there when where why how
    all any both each few more most other some such no nor not only own same so than too very
    s t can will just don should now
    aren't can't cannot could couldn't didn't doesn't don't hadn't hasn't haven't
    he'd he'll he's here's how's i'd i'll i'm i've isn't it's let's mustn't ought
    shan't she'd she'll she's shouldn't that's there's they'd they'll they're they've
    wasn't we'd we'll we're we've weren't what's when's where's who's why's won't would wouldn't
    you'd you'll you're you've
    """.split()
)

# Tokens of one mark that never count as content words.
PUNCTUATION_TOKENS = (",", ".", "(", ")", "'", "``", "'s", "''", "-", "?", ";", ":", "[", "]", "!", '"')

# Content stop words without a caller's list: the term list, the marks above and every single letter.
CONTENT_STOPWORDS = tuple(
    dict.fromkeys(TERM_STOPWORDS + PUNCTUATION_TOKENS + tuple(chr(c) for c in range(ord("a"), ord("z") + 1)))
)

# Namespaces whose pages and links are kept.
ACCEPTED_NAMESPACES = ("w", "wiktionary", "wikt")

TEMPLATE_NAMESPACE = "Template"

# Tags dropped when they close themselves.
SELF_CLOSING_TAGS = ("br", "hr", "nobr", "ref", "references", "nowiki")

# Tags dropped while their content stays.
IGNORED_TAGS = (
    "abbr", "b", "big", "blockquote", "center", "cite", "div", "em",
    "font", "h1", "h2", "h3", "h4", "hiero", "i", "kbd", "nowiki",
    "p", "plaintext", "s", "span", "strike", "strong",
    "sub", "sup", "tt", "u", "var",
)

# Elements dropped together with their content.
DISCARDED_ELEMENTS = (
    "gallery", "timeline", "noinclude", "pre",
    "table", "tr", "td", "th", "caption", "div",
    "form", "input", "select", "option", "textarea",
    "ul", "li", "ol", "dl", "dt", "dd", "menu", "dir",
    "ref", "references", "img", "imagemap", "source", "small",
)

# Elements replaced by a numbered word.
PLACEHOLDERS = {"math": "formula", "code": "codice"}

# Behaviour switches.
BEHAVIOUR_SWITCHES = (
    "__NOTOC__", "__FORCETOC__", "__TOC__", "__NEWSECTIONLINK__", "__NONEWSECTIONLINK__",
    "__NOGALLERY__", "__HIDDENCAT__", "__NOCONTENTCONVERT__", "__NOCC__", "__NOTITLECONVERT__",
    "__NOTC__", "__START__", "__END__", "__INDEX__", "__NOINDEX__", "__STATICREDIRECT__", "__DISAMBIG__",
)

# What an external link may start with.
URL_PROTOCOLS = (
    "bitcoin:", "ftp://", "ftps://", "geo:", "git://", "gopher://", "http://",
    "https://", "irc://", "ircs://", "magnet:", "mailto:", "mms://", "news:",
    "nntp://", "redis://", "sftp://", "sip:", "sips:", "sms:", "ssh://",
    "svn://", "tel:", "telnet://", "urn:", "worldwind://", "xmpp:", "//",
)

# Patterns of external links, of image addresses, of an error's element, of a named parameter.
_URL_CHARS = r'[^\]\[<>"\x00-\x20\x7F\s\p{Z}\x{85}]'
EXTERNAL_LINK = r"\[((?i:%s)%s+)[\s\p{Z}]*([^\]\x00-\x08\x0a-\x1F]*?)\]" % ("|".join(URL_PROTOCOLS), _URL_CHARS)
IMAGE_URL = (
    r"(?i)^(?:http://|https://)" + _URL_CHARS + r"+/[A-Za-z0-9_.,~%\-+&;#*?!=()@\x{80}-\x{FF}]+\.(?:gif|png|jpg|jpeg)$"
)
ERROR_ELEMENT = r'^<(?:strong|span|p|div)\s(?:[^\s>]*\s+)*?class="(?:[^"\s>]*\s+)*?error(?:\s[^">]*)?"'
NAMED_PARAMETER = r"(?s)^ *([^= ]*?) *=(.*)$"

# Noun endings and what each may be replaced by to reach the lemma.
NOUN_ENDINGS = (
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
)

# Characters that separate words, as a character class body.
UNICODE_SPACE = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
