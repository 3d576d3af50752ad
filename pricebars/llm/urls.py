"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path.

The regression learns from a small labelled table of URLs (``SEEDS`` unless another is given); rules fit a host and
its subdomains, and the longest that fits decides.  A model is one array of ``BUCKETS`` weights.
"""

import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
GRAMS = (3, 4, 5)
#: (verdict, host, path): the query's rules.
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
#: A small labelled table of hosts: everyday sites, among them names that mean nothing, and gambling, pharmacy, adult, advertising,
#: link farm, loan and malware sites.  The names of the pages to be judged are not in it.
CLEAN = """
daily-news.com citylibrary.org university.edu gardening-tips.net recipes.example.net history-museum.org weather.example.com
bookreview.net opensource.dev travelnotes.com science-journal.org localnews.de musee.fr revista.es encyclopedia.org
forum.example.org photography-blog.com mathworld.net therapy-center.net sports-results.com cooking-school.fr theatre.example.net
hospital-north.org town-council.gov art-history.edu windmill.org farmers-market.com track-and-field.org window-repair.com
adultlearning.edu freelance-writers.net address-book.example.com casing-parts.com bettertogether.org spammer-research.edu
brontide.example.com quillon.org ethandar.net oridian.example.org stelling.com marnethis.net ouranth.example.com verdin.org
aldenheim.de thornwick.net esteril.es lumeria.fr ganterhos.com inthered.example.net heratin.org ronesta.com untherion.example.org
shandle.net areston.com onthera.example.com bleston.org kestrelin.net pathology.org stationery.com nationwide.example.net
edition-press.com thinkers.org wander.example.com readers-corner.net singing-choir.org tenders.example.org anderson-law.com
""".split()
BLOCKED = """
casino-royal.com mega-casino.net online-casino.org live-casino-games.com casino-slots.net big-win.com win-jackpot.net instant-win.org
lotto-winner.com free-spins.com free-money.net get-free-gifts.org freebies-now.com sports-betting.com bets-online.net
best-bets.org bet-bonus.com poker-bets.net roulette-casino.com slots-win.org cheap-meds.com cheap-viagra.org cheap-rx.net
buy-cheap-drugs.com diet-pills.org pills-shop.net sleeping-pills.com generic-pills.org online-pharmacy-rx.net viagra-store.com
adult-videos.net adult-dating.com adult-cams.org hot-adult.net xxx-free.com x-rated.org x-tube.net porn-tube.net sexy-x.com
ads-server.com ads-network.net banner-ads.org pop-ads.com click-ads.net adserver.biz track-pixel.com click-track.net
user-track.org tracker-hub.net track-clicks.com spam-mail.com mail-spam.net seo-spam.org comment-spam.com link-farm.org
content-farm.net click-farm.com farm-links.org backlink-farm.net payday-loans.com quick-loans.net malware-download.net
lucky-slots.example.com viagra-meds.example.net hot-cams.example.org pixel-ads.example.com backlinks.example.net
crack-keys.example.org adult-chat.example.net bonus-bets.example.com x-movies.example.org winners-club.example.com
warez-crack.org keygen-crack.com phishing-login.net fake-login.org hacked-accounts.com botnet-rent.net
""".split()
_PLACES = (
    ("", "/"), ("www.", "/en/1042"), ("blog.", "/fr/2318.html"), ("m.", "/de/7745/"), ("news.", "/es/31?page=2&ref=x"),
    ("", "/articles/90021?utm_source=feed"), ("", "/index.html#top"),
)
#: URLs with 1 for those to block; every kind of path is on both sides.
SEEDS = tuple(
    (f"https://{prefix}{host}{path}", label)
    for label, hosts in ((0, CLEAN), (1, BLOCKED)) for i, host in enumerate(hosts) for prefix, path in (_PLACES[i % 7], _PLACES[(i + 3) % 7])
)


def host_of(url: str = "url") -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z in lower case; else empty."""
    found = F.regexp_extract(F.col(url), r"(?s)^(?:(?!://).)*://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(found, upper, upper.lower()), F.lit(""))


def path_of(url: str = "url") -> Column:
    """What follows the host, up to ``? #`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^(?:(?!://).)*://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none does."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, of, start in reversed(ordered):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(start)
        name, verdict = F.when(fits, of + start).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


_PART = re.compile(r"[^0-9A-Za-z\x80-\U0010ffff]+")


def _grams(text: str, salt: int) -> set[int]:
    """Buckets of the character n-grams of the parts of a host or path; a part is closed by ``^`` and ``$``."""
    found = set()
    for part in _PART.split(text.lower()):
        closed = f"^{part}$"
        for n in GRAMS:
            found.update(zlib.crc32(f"{salt}{closed[i : i + n]}".encode("utf-8", "surrogatepass")) % BUCKETS for i in range(len(closed) - n + 1))
    return found


def features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of the different n-grams of host and path."""
    found = [sorted(_grams(h, 1) | _grams(p, 2)) for h, p in zip(hosts, paths)]
    return np.repeat(np.arange(len(found)), [len(f) for f in found]), np.array([b for f in found for b in f], np.int64)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def score(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """Probability that a URL is one to block."""
        rows, columns = features(hosts, paths)
        logit = np.bincount(rows, self.weights[columns], len(hosts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))


def _split(url: str) -> tuple[str, str]:
    _, scheme, rest = url.partition("://")
    end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host, path = rest[:end], rest[end:].partition("?")[0].partition("#")[0]
    return (host.lower(), path) if scheme else ("", "")


def fit(
    seeds: Sequence[tuple[str, int]] = SEEDS, steps: int = 300, rate: float = 0.05, decay: float = 1e-4, clean: float = 0.8
) -> Model:
    """Full-batch Adam on the labelled URLs; those not to block have the share ``clean`` of the weight."""
    hosts, paths = zip(*[_split(url) for url, _ in seeds])
    y = np.array([label for _, label in seeds], float)
    share = np.where(y == 1, (1 - clean) / max(y.sum(), 1), clean / max((1 - y).sum(), 1))
    rows, columns = features(list(hosts), list(paths))
    w, b = np.zeros(BUCKETS), 0.0
    m, v = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(np.bincount(rows, w[columns], len(y)) + b)))
        slope = (p - y) * share
        grad = np.append(np.bincount(columns, slope[rows], BUCKETS) + decay * w, slope.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model(w, float(b))


def judge(pages: DataFrame, model: Model, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` and the model's ``score``.

    A null url, or one without ``://``, has an empty host and path and is judged by them.  Columns of these names are
    replaced; rows are judged one by one, so repeats are judged alike and no rows give none.
    """

    @F.arrow_udf("double")
    def scores(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        return pa.array(model.score(hosts.to_pylist(), paths.to_pylist()))

    split = pages.drop("host", "path", "rule", "verdict", "score").withColumns({"host": host_of(), "path": path_of()})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = split.withColumns({"rule": rule, "score": scores("host", "path")})
    other = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return judged.withColumn("verdict", F.coalesce(verdict, other))
