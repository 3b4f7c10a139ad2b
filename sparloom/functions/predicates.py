"""Column expressions: classifiers, predicates and small scalar functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values ---------------------------------------------------------------
PASSTHROUGH, UNCHANGED, DIFF, COMPRESSED = "passthrough", "unchanged", "diff", "compressed"
PEER_SEPARATOR = "__"
DIFF_SNIFF_CHARS = 40
IDENTITY_WORDS = (
    "id ids key keys name title slug uuid guid hash type kind status state path url uri command cmd version ref sha label tag "
    "count size timestamp date time"
).split()
PROSE_WORDS = (
    "evidence rationale note notes description desc summary detail details body text content comment comments explanation "
    "context snippet message msg reason readme abstract excerpt bio blurb"
).split()
LAUNCHERS = (
    "node nodejs npx npm pnpm pnpx yarn bun bunx deno uv uvx pipx pip poetry pdm conda mise nix nix-shell ruby perl java dotnet "
    "sh bash zsh pwsh powershell env sudo docker podman"
).split()
LAUNCHER_FAMILY = r"^(python|pypy|py)\d*(\.\d+)*$"
SENSITIVE_NAMES = (
    r"(?i)secret|credential|vault|passwd|password|token|api[-_ ]?key|keyring|auth"
    r"|1password|onepassword|bitwarden|lastpass|dashlane|keepass|\bop\b"
    r"|gmail|mail|inbox|contacts|calendar|photos|\bdrive\b|gdrive|onedrive|google-?drive"
)
WINDOW_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}
LONG_TEXT_CHARS = 2000
# ----------------------------------------------------------------------------


def token_count(text: Column) -> Column:
    """The deterministic counter: a quarter of the characters, at least 1."""
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4)).cast("long")


def token_stream(text: Column) -> Column:
    """Words, numbers and single other signs, in order."""
    return F.regexp_extract_all(text, F.lit(r"([A-Za-z]+|[0-9]+|[^A-Za-z0-9\s])"), F.lit(1))


def canonical_tool(server: Column, tool: Column) -> Column:
    """The tool without its own server's prefix, if something remains."""
    prefix = F.concat(server, F.lit(PEER_SEPARATOR))
    return F.when(F.startswith(tool, prefix) & (F.length(tool) > F.length(prefix)), F.substr(tool, F.length(prefix) + 1)).otherwise(tool)


def classify_decision(raw: Column, emitted: Column, ran: Column, marker: str) -> Column:
    """passthrough (codec did not run), unchanged, diff (marker near the start) or compressed."""
    return (
        F.when(~ran, PASSTHROUGH)
        .when(emitted == raw, UNCHANGED)
        .when(F.contains(F.substring(emitted, 1, DIFF_SNIFF_CHARS), F.lit(marker)), DIFF)
        .otherwise(COMPRESSED)
    )


def window_seconds(window: Column) -> Column:
    """'30m', '24h', '7d' as seconds; null for anything else."""
    clean = F.trim(window)
    unit = F.regexp_extract(clean, r"^[0-9]+([smhdw])$", 1)
    factor = F.lit(None).cast("long")
    for name, seconds in WINDOW_SECONDS.items():
        factor = F.when(unit == name, F.lit(seconds).cast("long")).otherwise(factor)
    return F.when(unit != "", F.regexp_extract(clean, r"^([0-9]+)", 1).cast("long") * factor)


def field_role(name: Column) -> Column:
    """identity, prose or unknown, from the words of a field path's last key."""
    leaf = F.replace(F.element_at(F.split(name, r"\."), -1), F.lit("[]"), F.lit(""))
    words = F.split(F.lower(F.regexp_replace(leaf, "([a-z0-9])([A-Z])", "$1 $2")), r"[\s_\-]+")
    has = lambda values: F.arrays_overlap(words, F.array(*map(F.lit, values)))
    return F.when(has(IDENTITY_WORDS), "identity").when(has(PROSE_WORDS), "prose").otherwise("unknown")


def server_of_tool(tool: Column, server: Column, hints: tuple[tuple[str, str], ...] = ()) -> Column:
    """The recorded server; failing that, the first hint (regex, server) the tool's name meets, then its head."""
    head = F.regexp_extract(tool, r"^([^._]*)", 1)
    guess = F.when(head != "", head).otherwise("other")
    for pattern, name in reversed(hints):
        guess = F.when(tool.rlike(pattern), name).otherwise(guess)
    return F.coalesce(F.nullif(server, F.lit("")), guess)


def is_launcher(label: Column) -> Column:
    """A command name that only starts other programs."""
    name = F.regexp_replace(F.lower(label), r"\.exe$", "")
    return name.isin(LAUNCHERS) | name.rlike(LAUNCHER_FAMILY)


def never_lossy(server: Column, listed: list[str]) -> Column:
    known = F.coalesce(server, F.lit("")) != ""
    return known & (server.isin(listed) | server.rlike(SENSITIVE_NAMES))


def shape_of_text(raw: Column) -> Column:
    """Shape of a payload that is not JSON."""
    return F.when(F.length(raw) >= LONG_TEXT_CHARS, "long-text").otherwise("other")


def sanitize(name: Column) -> Column:
    return F.regexp_replace(name, r"[^A-Za-z0-9._-]+", "_")


def payload_id(raw: Column) -> Column:
    return F.substring(F.sha1(raw.cast("binary")), 1, 8)


def redact(header: Column) -> Column:
    """Mask the value of a header that looks like a credential."""
    return F.regexp_replace(header, r"(?i)^([^:=]*(?:auth|token|secret|key|cookie|password)[^:=]*[:=]\s*).+$", "$1***")


def truncate(text: Column, most: int = 120) -> Column:
    """The first ``most`` characters and how many more there were."""
    more = F.concat(F.substring(text, 1, most), F.lit("…⟨+"), (F.length(text) - most).cast("string"), F.lit(" chars⟩"))
    return F.when(F.length(text) > most, more).otherwise(text)


def drop_handle(tool: Column, path: Column, value: Column) -> Column:
    """A short handle that names a dropped value (quotes and backslashes escaped as in JSON)."""
    quote = lambda x: F.concat(F.lit('"'), F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    return F.substring(F.sha1(F.concat(F.lit("["), F.concat_ws(", ", quote(tool), quote(path), quote(value)), F.lit("]")).cast("binary")), 1, 16)


def percent_saved(raw: Column, out: Column) -> Column:
    return F.try_divide((raw - out) * 100.0, raw.cast("double"))


def base36(n: Column) -> Column:
    return F.lower(F.conv(n.cast("string"), 10, 36))


def glob_to_regex(glob: str) -> str:
    """A case-sensitive shell glob as an anchored regular expression of the JVM."""
    out, i = "", 0
    while i < len(glob):
        ch = glob[i]
        i += 1
        if ch == "*":
            out += ".*"
        elif ch == "?":
            out += "."
        elif ch == "[" and (end := glob.find("]", i + 1 + (glob[i : i + 1] == "!"))) > 0:
            body = glob[i:end].replace("\\", "\\\\").replace("[", "\\[").replace("]", "\\]").replace("&&", "&\\&")
            out += "[" + ("^" + body[1:] if body[:1] == "!" else "\\" + body if body[:1] == "^" else body) + "]"
            i = end + 1
        else:
            out += re.escape(ch)
    return f"(?s)\\A{out}\\z"
