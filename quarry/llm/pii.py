"""Personal data: fixed patterns, and a linear-chain CRF for what they miss.

The patterns find plain e-mail addresses, IP addresses, card and phone numbers.
The conditional random field labels the words of a line by their shapes (runs of
letters, digits and signs, with the lengths of digit runs), by the known words
among them and by their neighbours' shapes.  It is trained from a small table of
marked lines and decoded by Viterbi, for all lines of a batch at once.  What it
finds is kept if it passes its kind's own check (digit counts, Luhn, parts up to
255) and touches no span of a pattern: spans are added, never replaced.

A line is one chain, however long.  Work and memory are linear in the text;
nothing is shuffled, every task scores its own rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
CHUNK = 1 << 22  # characters whose lines are decoded together; a longer line stays whole
PART = 1 << 18  # characters whose features are computed at once
MAX_LABELLED = 5_000  # rows the training table may have; a larger one fails instead of being cut

# Lines with marked spans, <kind:text>: forms that the fixed patterns miss, plain
# forms, and numbers and words that are no personal data.
MARKED_LINES = """
write to <email:jane.doe at example dot org> for a copy
mail me at <email:john at mail dot example dot com> please
contact <email:m.keller (at) uni-berlin (dot) de> today
contact: <email:anna [at] firma [dot] de>
reach us under <email:info(at)shop-online.com>, thanks
email <email:sales[at]store.example.net> or call
<email:peter_h AT company DOT com> is the address
send it to <email:lucie.b(a)mail.fr> before noon
e-mail: <email:k.smith at domain dot co dot uk>
ask <email:help at example dot com>.
my mail is <email:r2d2 [at] robots.org> now
adresse <email:marie.dupont at exemple dot fr> merci
correo <email:jose (at) ejemplo (dot) es> gracias
kontakt <email:b.meier(at)post.de> bitte
write <email:jane@example[.]com> instead
and <email:bob.s@mail[.]example[.]org> too
mail <email:ops@host(dot)net> about it
drop a line to <email:kim at uni dot edu> and wait
my address is <email:eva.n [at] museum [dot] it>, thanks
the office has <email:team(at)bau-werk.de>, ask there
mail <email:olaf at news dot server dot net> tonight
she uses <email:nina_s at posta dot hu>
please ask <email:lab.one (at) campus (dot) edu>.
or <email:desk[at]radio-sued.de>, or come by
plain <email:a.b@example.com> address
use <email:hans@mail.de> or <email:hans at post dot de>, both work
<email:ines.p@correo.es> or <email:ines (at) casa (dot) es>
either <email:x.one@host.org> and <email:y.two@host.org> or nobody
the address <email:carol.77@mail3.example.com>, as before
reply to <email:x.y_z@sub.domain.org>.
server <ip:192[.]168[.]0[.]12> was down
from <ip:10[.]0[.]0[.]1> to <ip:172[.]16[.]254[.]3>
blocked <ip:203(.)0(.)113(.)9> yesterday
host <ip:198[.]51[.]100[.]23>, port 80
attack of <ip:45[.]9[.]20[.]101>, later again
the node <ip:100[.]64[.]8[.]200> is up
login from <ip:8 . 8 . 4 . 4> at night
address <ip:93[.]184[.]216[.]34>.
the ip <ip:145.20.3.77> is plain
seen at <ip:10.1.22.133>, twice
card <card:4111.1111.1111.1111> was charged
pay with <card:5500/0000/0000/0004> now
number <card:4012_8888_8888_1881> expires soon
card: <card:3782 . 822463 . 10005>
charged <card:6011.1111.1111.1117>, thanks
card <card:5454.5454.5454.5454> on file
he paid with <card:4917.6100.0000.0000> here
mastercard <card:5555/5555/5555/4444>, valid
the card <card:4222_2222_2222_2>.
plain <card:4111111111111111> number
visa <card:4012 8888 8888 1881> again
call <phone:(030) 555-1234> after six
call me on <phone:555-123-4567> or later
phone <phone:(212) 555 0147>.
please call <phone:(415) 555-0199>!
ring <phone:(06) 555-0133>, or write
tel <phone:030/5551234> bitte
tel. <phone:089 / 123 4567> erreichbar
tél <phone:01 42 68 53 00> merci
telefon: <phone:0171 555 12 34>
mobile <phone:07700 900 123> only
fax <phone:(0044) 20 7946 0958>, office
ring <phone:020 7946 0018> tonight
call <phone:773-555-0142> or <phone:(773) 555-0143>
tel <phone:040/3335551> im büro
telefon <phone:0221/555012>, abends
our phone is <phone:(503) 555-0110> all day
mobil <phone:0160 555 43 21> oder
handy <phone:0176 555 8 21>.
text me at <phone:206-555-0199>.
llama al <phone:91 555 12 34> mañana
number is <phone:1-800-555-0199>
phone: <phone:202.555.0143> ext
whatsapp <phone:0049 170 5551234> please
plain <phone:+1 (555) 010-9988> phone
call <phone:+49 30 901820> now
at the end of the day we meet at noon
look at example 3 and dot the line
we met at a cafe at the dot of ten
he looked at the map and put a dot on it
stay at home or at work
version 3.2.1 was released on 2021-04-05
the year 1984 and the year 2001 were long
in 12 of 30 cases 4.5 percent was lost
licensed under CC BY-NC 4.0.
public license, version 3.
section 4.2.11 of chapter 10
order 100-2000-33 was shipped on 12.03.2019
the price is 1,299.00 or 12.50 each
isbn 978-3-16-148410-0 was printed twice
from 10:30 to 12:45 on 01/02/2003
see pages 120-135 and 240-251
build 10.0.19041.1 of the system
invoice 2020/000123/77 of 3 may
about 1 000 000 people and 25 000 cars
token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"
key "9C8B45435718DCC700C184A7E303CDC64C6A8F7F" in use
id 7f3a-11b2-99aa-0c12 in the log
score 3:2 after 90 minutes
temperature of -12.5 to +30.1 degrees
on 5 june 1999 at 17:00 in room 101
room 12 floor 3 house 44
equation x_1 + x_2 = 10 holds
a = b + c and d = e / f
ratio 16/9 or 4/3 on the screen
###... the !! and *** of %%% text $$$
the end. or not, is it? yes!
the people in the village had not seen the river rise like this before
she said that it was late and that they would leave in the morning
it is one of the oldest houses on the street, built of red stone
they walked along the shore and spoke of what had happened
nothing of the kind was ever found, although many looked for it.
he works for a small company that makes tools for farms
wir haben den ganzen tag auf den zug gewartet und nichts gesehen
das haus an der ecke wurde vor vielen jahren gebaut
die kinder spielten im garten, bis es dunkel wurde
nous avons marché le long de la rivière avant la nuit
il y a des jours où rien ne se passe dans la ville
elle a dit que les enfants étaient partis avec leur père
la casa de mi abuelo estaba cerca del mar y del puerto
no hay nada que hacer en este pueblo cuando llueve
los niños que vivían en la calle jugaban con una pelota
Thnt erinsh anonwh thatly. Onre, tionthe hashed inre
und die der das nicht mit
le la les des une est dans
el la los que con por para
| one | two | three | four |
item 0042 costs 17 and item 0043 costs 18
between 1914 and 1918 and 1939-1945
serial 123456789012345678901234567890
123 456 main street apartment 7
chapter 1 2 3 4 5 6 7
1. first 2. second 3. third
- 10 eggs - 200 g flour - 3 dl milk
v1.2.3.4.5 and r2.0.0-rc1
http://example.com/a/b?c=1 and www.example.org
#1 of 20 at 99% in 2.5 s
"""
MARK = re.compile(r"<(email|ip|card|phone):([^>]*)>")

CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DOTTED = re.compile(r"[0-9][0-9.]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, int]  # start, kind number, end


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost and not overlapping within a kind,
    by start and kind.  Every pattern takes time linear in the text."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_SIGNS:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            out.append((start, 0, free))
        else:
            free = at  # no later address can reach over this sign
        at = text.find("@", max(at + 1, free))
    for run in DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        place, parts = run.start(), []
        for part in run.group().split("."):
            parts = [*parts, (place, part)] if part else []
            if len(parts) == 4:
                if all(_small(p) for _, p in parts):
                    out.append((parts[0][0], 1, place + len(part)))
                parts = []
            place += len(part) + 1
    for found in CARD.finditer(text):
        if found.end() - found.start() >= 12:
            digits = _digits(found.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((found.start(), 2, found.end()))
    for found in PHONE.finditer(text):
        if 9 <= len(_digits(found.group())) <= 15:
            out.append((found.start(), 3, found.end()))
    return sorted(out)


# ---- words and their features

LETTER, CAPITAL, DIGIT, AT, DOT, DASH, PLUS, OPEN, CLOSE, SLASH, LOW, STOP, OTHER = range(13)


def _classes() -> np.ndarray:
    table = np.full(0x110000 >> 8 << 8, LETTER, np.uint8)  # other scripts count as letters
    table[:128] = OTHER
    for chars, kind in (("abcdefghijklmnopqrstuvwxyz", LETTER), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", CAPITAL), ("0123456789", DIGIT), ("@", AT), (".", DOT),
                        ("-", DASH), ("+", PLUS), ("([{<", OPEN), (")]}>", CLOSE), ("/", SLASH), ("_", LOW), (",;:!?\"'", STOP)):
        for c in chars:
            table[ord(c)] = kind
    return table


CLASS = _classes()
STEP = 0x9E3779B97F4A7C15  # odd, so its powers have inverses modulo 2 ** 64
BACK = pow(STEP, -1, 1 << 64)
_tables: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2 ** 64; kept, as all chunks use the same."""
    if len(_tables.get(base, ())) < n:
        size = 1 << max(n - 1, 1).bit_length()
        steps = np.full(size, np.uint64(base))
        steps[0] = 1
        _tables[base] = np.cumprod(steps, dtype=np.uint64)
    return _tables[base][:n]


def words_of(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of code points, and the line number of each."""
    space = (chars == 32) | (chars - 9 < 5)  # unsigned: 9 to 13
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    line = np.searchsorted(np.flatnonzero(chars == 10), starts)
    return starts, ends, line


def features(chars: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Three codes a word: its shape (runs of one class, with the lengths of digit
    runs), the classes it holds with its digit count, and its letters in lower
    case at their places.  Codes are polynomial hashes, taken as differences
    of running sums."""
    if not len(starts):
        return [np.zeros(0, np.uint64)] * 3
    kind = CLASS[np.minimum(chars, len(CLASS) - 1)]
    change = kind[1:] != kind[:-1]
    change[starts[starts > 0] - 1] = True
    change[ends[ends < len(chars)] - 1] = True
    at = np.concatenate([[0], np.flatnonzero(change) + 1])
    length = np.diff(at, append=len(chars))
    run = kind[at].astype(np.int64)
    first, last = np.searchsorted(at, starts), np.searchsorted(at, ends)
    code = (1 + np.where(run == DIGIT, 16 + np.minimum(length, 9), run)).astype(np.uint64)
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum(code * _powers(STEP, len(at)), dtype=np.uint64)])
        shape = (total[last] - total[first]) * _powers(BACK, len(at) + 1)[first]
        digits = np.concatenate([[0], np.cumsum(np.where(run == DIGIT, length, 0))])
        # every second stretch is a word, the others are the spaces between
        signs = np.bitwise_or.reduceat(np.append(np.left_shift(1, run), 0), np.stack([first, last], axis=1).ravel())[::2]
        mixed = (signs * 32 + np.minimum(digits[last] - digits[first], 20) + 1).astype(np.uint64) * np.uint64(STEP)
        lowered = np.where(kind <= CAPITAL, chars + np.where(kind == CAPITAL, 32, 0), 0).astype(np.uint64)
        total = np.concatenate([[np.uint64(0)], np.cumsum(lowered * _powers(STEP, len(chars)), dtype=np.uint64)])
        name = (total[ends] - total[starts]) * _powers(BACK, len(chars) + 1)[starts]
    return [shape, mixed, name]


# ---- the model

CONTEXT = [(f, d) for d in (0, -1, 1) for f in (0, 1, 2)] + [(2, -2), (2, 2)]  # (code, words away) of every feature column
UNKNOWN, EDGE_WORD = 0, 1  # numbers of codes the training lines lack, and of places beyond a line


class Lookup:
    """Numbers of known 64-bit codes: one multiplication and one table, without collisions among the known."""

    BITS = 18

    def __init__(self, known: np.ndarray):
        self.known = np.concatenate([np.zeros(2, np.uint64), known])
        self.factor = np.uint64(1)
        for k in range(1, 1000):
            self.factor = np.uint64((STEP * (2 * k + 1)) % (1 << 64))
            if len(np.unique(self._slot(known))) == len(known):
                break
        self.table = np.zeros(1 << self.BITS, np.int32)
        self.table[self._slot(known)] = np.arange(2, len(known) + 2)

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((codes ^ (codes >> np.uint64(29))) * self.factor) >> np.uint64(64 - self.BITS)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        at = self.table[self._slot(codes)]
        return np.where(self.known[at] == codes, at, UNKNOWN)


class Model:
    """Known codes, their weights per feature column and label, and the transitions."""

    def __init__(self, lookups: list[Lookup], weights: list[np.ndarray], moves: Moves):
        self.lookups, self.weights, self.moves = lookups, weights, moves

    def numbers(self, columns: list[np.ndarray], line: np.ndarray) -> list[np.ndarray]:
        """The known number of every feature of every word."""
        own = [look(c) for look, c in zip(self.lookups, columns, strict=True)]
        out = []
        for f, d in CONTEXT:
            if not d:
                out.append(own[f])
                continue
            moved = np.full_like(own[f], EDGE_WORD)
            if abs(d) < len(line):
                same = line[abs(d):] == line[:-abs(d)]
                if d < 0:
                    moved[-d:] = np.where(same, own[f][:d], EDGE_WORD)
                else:
                    moved[:-d] = np.where(same, own[f][d:], EDGE_WORD)
            out.append(moved)
        return out

    def emissions(self, columns: list[np.ndarray], line: np.ndarray) -> np.ndarray:
        total = np.zeros((len(line), len(LABELS)), np.float32)
        for w, at in zip(self.weights, self.numbers(columns, line), strict=True):
            total += w[at]
        return total


OUTER = np.array([b for b in range(len(LABELS)) if b % 2 or not b])  # labels that may follow any label: O and the beginnings


class Moves:
    """Transition scores: leaving a label plus entering an outer one, and going on inside a kind."""

    def __init__(self, leave: np.ndarray, enter: np.ndarray, begin: np.ndarray, stay: np.ndarray, first: np.ndarray):
        self.leave, self.enter, self.begin, self.stay, self.first = leave, enter, begin, stay, first

    def matrix(self) -> np.ndarray:
        """The score of label b after label a; minus infinity for an inside label after another kind."""
        k = len(LABELS)
        out = np.full((k, k), -np.inf)
        out[:, OUTER] = self.leave[:, None] + self.enter
        inside = np.arange(2, k, 2)
        out[inside - 1, inside] = self.begin
        out[inside, inside] = self.stay
        return out

    def start(self) -> np.ndarray:
        """The score of a first label."""
        out = np.full(len(LABELS), -np.inf)
        out[OUTER] = self.first
        return out


def _packed(line: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of every chain, longest first, and how many are longer than t."""
    starts = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else np.zeros(0, int)
    sizes = np.diff(np.concatenate([starts, [len(line)]])).astype(int)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    active = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), side="left")
    return starts, sizes, active


def viterbi(scores: np.ndarray, line: np.ndarray, moves: Moves) -> np.ndarray:
    """Best label of every word; the chains of all lines advance together."""
    n, labels = scores.shape
    best = np.zeros(n, np.int8)
    if not n:
        return best
    starts, sizes, active = _packed(line)
    source = np.zeros(n, np.int8)  # best label before an outer one
    went_on = np.zeros((n, labels // 2), bool)  # inside a kind: the label before was inside, too
    now = scores[starts] + moves.start().astype(scores.dtype)
    last = now.copy()
    for t in range(1, len(active)):
        k = active[t]
        at = starts[:k] + t
        left = now[:k] + moves.leave
        choice = left.argmax(axis=1)
        source[at] = choice
        begun, stayed = now[:k, 1::2] + moves.begin, now[:k, 2::2] + moves.stay
        went_on[at] = stayed > begun
        now = scores[at]
        now[:, OUTER] += left[np.arange(k), choice][:, None] + moves.enter
        now[:, 2::2] += np.maximum(begun, stayed)
        done = active[t + 1] if t + 1 < len(active) else 0
        last[done:k] = now[done:k]
    label = last.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        k = active[t]
        at = starts[:k] + t
        here = label[:k]
        best[at] = here
        inside = (here > 0) & (here % 2 == 0)
        on = went_on[at, np.maximum(here // 2 - 1, 0)]
        label[:k] = np.where(inside, np.where(on, here, here - 1), source[at])
    return best


def _padded(line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, sizes, _ = _packed(line)
    width = sizes.max()
    at = starts[:, None] + np.arange(width)
    live = np.arange(width) < sizes[:, None]
    return np.where(live, at, 0), live


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def log_likelihood(scores: np.ndarray, line: np.ndarray, moves: np.ndarray, first: np.ndarray,
                   labels: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Log likelihood of ``labels`` and its gradients by forward-backward:
    per word and label, per transition, per first label."""
    at, live = _padded(line)
    e = scores[at]
    rows, width, k = e.shape
    alpha, beta = np.zeros_like(e), np.zeros_like(e)
    alpha[:, 0] = e[:, 0] + first
    for t in range(1, width):
        step = _logsum(alpha[:, t - 1, :, None] + moves, 1) + e[:, t]
        alpha[:, t] = np.where(live[:, t, None], step, alpha[:, t - 1])
    for t in range(width - 2, -1, -1):
        step = _logsum(moves + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        beta[:, t] = np.where(live[:, t + 1, None], step, 0)
    total = _logsum(alpha[:, -1], 1)
    share = np.exp(alpha + beta - total[:, None, None]) * live[:, :, None]
    truth = np.zeros_like(e)
    np.put_along_axis(truth, labels[at][:, :, None].astype(int), 1.0, axis=2)
    truth *= live[:, :, None]
    by_word = np.zeros_like(scores)
    by_word[at[live]] = (truth - share)[live]
    by_move = np.zeros((k, k))
    for t in range(1, width):
        joint = alpha[:, t - 1, :, None] + moves + (e[:, t] + beta[:, t])[:, None, :] - total[:, None, None]
        by_move += (truth[:, t - 1, :, None] * truth[:, t, None, :] - np.exp(joint) * live[:, t, None, None])[live[:, t]].sum(axis=0)
    gained = (e * truth).sum() + (truth[:, 0] * np.where(np.isfinite(first), first, 0)).sum()
    steps = truth[:, :-1, :, None] * truth[:, 1:, None, :]
    gained += (steps * np.where(np.isfinite(moves), moves, 0)).sum()
    return float(gained - total.sum()), by_word, by_move, (truth - share)[:, 0].sum(axis=0)


def parse_marked(text: str) -> tuple[str, list[Span]]:
    """A marked line as plain text and its spans."""
    plain, spans, done = "", [], 0
    for m in MARK.finditer(text):
        plain += text[done:m.start()]
        spans.append((len(plain), KINDS.index(m[1]), len(plain) + len(m[2])))
        plain += m[2]
        done = m.end()
    return plain + text[done:], spans


def _codes(texts: Sequence[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def _labels(starts: np.ndarray, ends: np.ndarray, spans: Sequence[Span]) -> np.ndarray:
    out = np.zeros(len(starts), np.int8)
    for start, kind, end in spans:
        touched = np.flatnonzero((starts < end) & (ends > start))
        out[touched] = 2 + 2 * kind
        out[touched[:1]] = 1 + 2 * kind
    return out


def _single_line(codes: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Which codes occur in one line only."""
    pairs = np.unique(np.stack([codes, line.astype(np.uint64)], axis=1), axis=0)
    known, times = np.unique(pairs[:, 0], return_counts=True)
    return times[np.searchsorted(known, codes)] == 1


def train(marked: Sequence[str], rounds: int = 150, rate: float = 0.1, ridge: float = 0.02) -> Model:
    """Fit the field to marked lines: full gradients by forward-backward, Adam steps, a ridge on the weights."""
    parsed = [parse_marked(" ".join(x.split("\n"))) for x in marked]
    text, spans = "", []
    for plain, found in parsed:
        spans += [(a + len(text), k, b + len(text)) for a, k, b in found]
        text += plain + "\n"
    starts, ends, line = words_of(_codes([text]))
    labels = _labels(starts, ends, spans)
    columns = features(_codes([text]), starts, ends)
    # every line counts twice, once with the codes that only its own line holds taken for unknown
    seen = [_single_line(c, line) for c in columns]
    lookups = [Lookup(np.unique(c)) for c in columns]
    columns = [np.concatenate([c, np.where(alone, np.uint64(0), c)]) for c, alone in zip(columns, seen, strict=True)]
    line = np.concatenate([line, line + len(marked)])
    labels = np.concatenate([labels, labels])
    k, outer, kinds = len(LABELS), len(OUTER), len(KINDS)
    inside = np.arange(2, k, 2)
    shapes = [(len(lookups[f].known), k) for f, _ in CONTEXT] + [(k,), (outer,), (kinds,), (kinds,), (outer,)]
    params = [np.zeros(s) for s in shapes]
    mean, square = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    numbers = Model(lookups, params[:-5], Moves(*params[-5:])).numbers(columns, line)
    for step in range(1, rounds + 1):
        moves = Moves(*params[-5:])
        scores = sum(w[at] for w, at in zip(params[:-5], numbers, strict=True))
        _, by_word, by_move, by_first = log_likelihood(scores, line, moves.matrix(), moves.start(), labels)
        grads = []
        for w, at in zip(params[:-5], numbers, strict=True):
            g = np.zeros_like(w)
            np.add.at(g, at, by_word)
            grads.append(g)
        grads += [by_move[:, OUTER].sum(axis=1), by_move[:, OUTER].sum(axis=0), by_move[inside - 1, inside], by_move[inside, inside], by_first[OUTER]]
        for i, g in enumerate(grads):
            g = g - ridge * params[i]
            mean[i] = 0.9 * mean[i] + 0.1 * g
            square[i] = 0.999 * square[i] + 0.001 * g * g
            params[i] += rate * (mean[i] / (1 - 0.9 ** step)) / (np.sqrt(square[i] / (1 - 0.999 ** step)) + 1e-8)
    params = [p.astype(np.float32) for p in params]
    return Model(lookups, params[:-5], Moves(*params[-5:]))


# ---- finding

EDGE = " \t\r\x0b\x0c.,;:!?\"'*#$%&|="
AT_FORM = re.compile(r"@|[(\[{<]\s*(?:at|a)\s*[)\]}>]|\sat\s", re.IGNORECASE)
DOT_FORM = re.compile(r"[A-Za-z0-9]\.[A-Za-z0-9]|[(\[{<]\s*(?:dot|\.)\s*[)\]}>]|\sdot\s", re.IGNORECASE)


def plausible(kind: int, text: str) -> bool:
    """The check that a span of the field must pass."""
    if kind == 0:
        return bool(AT_FORM.search(text) and DOT_FORM.search(text))
    if kind == 1:
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(_small(p) for p in parts)
    digits = _digits(text)
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 7 <= len(digits) <= 15


def _scored(model: Model, chars: np.ndarray) -> tuple[np.ndarray, ...]:
    starts, ends, line = words_of(chars)
    return starts, ends, line, model.emissions(features(chars, starts, ends), line)


def field_spans(model: Model, pieces: Sequence[str], part: int = PART) -> list[list[Span]]:
    """Spans that the field finds in each piece; pieces are whole lines.  Features
    are computed for some pieces at a time, then all lines are decoded together."""
    out: list[list[Span]] = [[] for _ in pieces]
    edges = np.cumsum([0] + [len(p) + 1 for p in pieces])
    cuts = np.searchsorted(edges, np.arange(0, edges[-1], part), side="left")
    cuts = np.unique(np.append(cuts, len(pieces)))
    scored, lines = [], 0
    for a, b in zip(cuts, cuts[1:]):
        starts, ends, line, scores = _scored(model, _codes([p + "\n" for p in pieces[a:b]]))
        if len(starts):
            scored.append((starts + edges[a], ends + edges[a], line + lines, scores))
            lines += int(line[-1]) + 1
    if not scored:
        return out
    starts, ends, line, scores = (np.concatenate(x) for x in zip(*scored))
    best = viterbi(scores, line, model.moves)
    heads = np.flatnonzero(best % 2 == 1)
    owner = np.searchsorted(edges, starts[heads], side="right") - 1
    for h, piece in zip(heads.tolist(), owner.tolist(), strict=True):
        stop = h + 1
        while stop < len(best) and best[stop] == best[h] + 1 and line[stop] == line[h]:
            stop += 1
        a, b = int(starts[h] - edges[piece]), int(ends[stop - 1] - edges[piece])
        text = pieces[piece]
        while a < b and text[a] in EDGE:
            a += 1
        while a < b and text[b - 1] in EDGE:
            b -= 1
        kind = (int(best[h]) - 1) // 2
        if a < b and plausible(kind, text[a:b]):
            out[piece].append((a, kind, b))
    return out


def line_pieces(text: str, limit: int) -> Iterator[tuple[int, str]]:
    """Offset and text of pieces of whole lines, of up to ``limit`` characters where lines allow it."""
    at = 0
    while at < len(text):
        stop = len(text) if len(text) - at <= limit else text.rfind("\n", at, at + limit) + 1
        if stop <= at:  # a line longer than the limit
            stop = text.find("\n", at + limit) + 1 or len(text)
        yield at, text[at:stop]
        at = stop


def find_spans(model: Model, texts: Sequence[str], chunk: int = CHUNK) -> Iterator[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text; bounded by ``chunk`` and the longest line."""
    def solved(work: list[tuple[int, int, str]]) -> Iterator[tuple[int, Span]]:
        for (k, at, _), spans in zip(work, field_spans(model, [p for _, _, p in work]), strict=True):
            for a, kind, b in spans:
                yield k, (a + at, kind, b + at)

    added: list[list[Span]] = [[] for _ in texts]
    work, size = [], 0
    for k, text in enumerate(texts):
        for at, piece in line_pieces(text, chunk):
            if work and size + len(piece) > chunk:
                for owner, span in solved(work):
                    added[owner].append(span)
                work, size = [], 0
            work.append((k, at, piece))
            size += len(piece)
    for owner, span in solved(work):
        added[owner].append(span)
    for k, text in enumerate(texts):
        base = base_spans(text)
        yield base, _clear(added[k], base)


def _clear(spans: list[Span], base: list[Span]) -> list[Span]:
    """The spans that overlap no base span; both lists are ordered by start."""
    if not base:
        return spans
    starts = np.array([a for a, _, _ in base])
    reach = np.maximum.accumulate([b for _, _, b in base])  # farthest end so far
    out = []
    for a, kind, b in spans:
        at = int(np.searchsorted(starts, b)) - 1  # base spans that start before this one ends
        if at < 0 or reach[at] <= a:
            out.append((a, kind, b))
    return out


def spans_text(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def labelled_lines(spark: SparkSession) -> DataFrame:
    """The small training table: one marked line a row."""
    return spark.createDataFrame([(x,) for x in MARKED_LINES.strip().split("\n")], "marked string")


def find_personal_data(docs: DataFrame, labelled: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``doc_id``, base counts ``n_email n_ip n_card n_phone``, ``base_sha256``,
    ``spans`` (base and added, by start and kind) and ``n_added`` of every row of ``docs``.

    ``labelled`` holds marked lines in ``marked``; null lines count as empty.  It
    is small by contract: more than ``max_labelled`` rows are an error.  The model
    depends on the table's rows alone, not on their order.

    A null text counts as empty: no span, the digest of the empty text.  A null
    ``doc_id`` stays null, repeated rows stay repeated, other columns are not
    read, an empty table gives an empty result.  Texts of any length are taken
    whole, a chunk of lines at a time.
    """
    rows = labelled.select(F.coalesce("marked", F.lit("")).alias("marked")).limit(max_labelled + 1).collect()
    if len(rows) > max_labelled:
        raise ValueError(f"more than {max_labelled} labelled rows")
    model = train(sorted(r.marked for r in rows)) if rows else None
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = find_spans(model, texts) if model else ((base_spans(t), []) for t in texts)
            counts: list[list[int]] = [[] for _ in KINDS]
            digests, spans, extra = [], [], []
            for base, added in found:
                for k in range(len(KINDS)):
                    counts[k].append(sum(kind == k for _, kind, _ in base))
                plain = spans_text(base)
                digests.append(hashlib.sha256(plain.encode()).hexdigest())
                spans.append(spans_text([*base, *added]) if added else plain)
                extra.append(len(added))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(extra, pa.int64())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        find, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
