"""URL filters: rules by host and path, and a logistic regression for the rest.

The regression reads the character n-grams of host and path, hashed into a fixed
number of slots, and learns from a small labelled table of URLs. Learning and
judging are DataFrame functions and Spark's own estimator; no row enters Python.

A null URL, or one without `://`, has an empty host and path; no rule fits it and
the regression judges it by its intercept. Repeated rows are judged each, and
columns beside id and URL are not read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
SLOTS = 8192
GRAMS = (3, 4, 5)
CUT = 0.5

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Rule(NamedTuple):
    """`verdict` for `host`, its subdomains, and paths that begin with `path`."""

    host: str
    path: str
    verdict: str


# The rules, and the labelled URLs to learn from.
RULES = [
    Rule("com", "/", ALLOW),
    Rule("example.com", "/en/", BLOCK),
    Rule("www.example.com", "/en/", ALLOW),
    Rule("net", "/es/", BLOCK),
    Rule("net", "/fr/", BLOCK),
]
BLOCKED_URLS = """
https://www.royal-casino-bonus.com/free-spins
http://online-poker-room.org/signup
https://www.bet-now-live.info/odds/football
http://sportsbets24.biz/free-bet
https://www.mega-slots-jackpot.com/play
http://lucky-roulette.net/win-real-money
https://www.best-xxx-tube.org/videos/1
http://free-porn-clips.net/watch
https://www.hot-adult-cams.tv/live
http://sexy-singles-tonight.com/hookup
https://www.local-escorts-guide.info/city
http://nude-webcam-chat.org/join
https://www.cheap-viagra-online.com/order
http://buy-cialis-pills.net/no-prescription
https://www.canadian-pharmacy-discount.info/meds
http://diet-pills-miracle.com/lose-weight-fast
https://www.order-generic-meds.org/cheap
http://payday-loans-instant.com/apply-now
https://www.fast-cash-advance.net/bad-credit
http://repair-your-credit-score.info/offer
https://www.double-your-bitcoin.io/deposit
http://crypto-airdrop-claim.org/wallet
https://www.forex-signals-profit.com/guaranteed
http://make-money-from-home.biz/earn-daily
https://www.get-rich-quick-system.com/secret
http://free-iphone-winner.com/claim-prize
https://www.you-won-a-gift-card.org/survey
http://click-here-to-win.info/lottery
https://www.claim-your-reward.xyz/bonus
http://replica-watches-outlet.com/rolex
https://www.fake-designer-bags.net/sale
http://cheap-followers-likes.org/buy-instagram
https://www.buy-backlinks-seo.net/package
http://link-farm-directory.info/submit-link
https://www.spam-blaster-mailer.com/bulk-email
http://comment-spam-bot.net/download
https://www.cracked-software-free.org/keygen
http://warez-download-full.net/serial-key
https://www.nulled-scripts-themes.info/free
http://torrent-movies-hd.to/download
https://www.pirate-streams-free.tv/watch-live
http://mod-apk-unlimited.org/hack
https://www.game-cheats-aimbot.net/hacks
http://driver-update-now.info/setup.exe
https://www.pc-cleaner-registry-fix.com/install.exe
http://your-computer-is-infected.net/scan
https://www.secure-login-verify-account.org/signin
http://bank-account-update.info/confirm-password
https://www.account-suspended-alert.xyz/verify
http://parcel-tracking-fee.top/pay
https://ads.clicktracker.net/pixel
http://adserver.popunder.org/banner
https://track.affiliate-clicks.com/redirect
http://pop-ads-network.net/impression
https://www.cheap-essay-writing.com/buy-essay
http://fake-diploma-degree.net/order-now
https://www.psychic-love-spells.org/call-now
http://miracle-cure-secret.com/doctors-hate
https://www.vpn-free-unlimited-pro.xyz/apk
http://hot-deals-discount-coupons.biz/sale
https://www.domain-for-sale-parked.com/buy
http://toolbar-search-hijack.org/install
https://www.win-casino-vip.ru/bonus
http://cheap-pills-shop.cc/cart
https://www.sex-toys-discount.xxx/buy
http://live-betting-tips.club/fixed-matches
https://adult-dating-club.org/members
http://www.adult-movies-free.net/hd
https://teen-adult-pics.info/gallery
http://spam-links-directory.org/add-url
https://www.content-spam-articles.net/en/3
http://article-farm-spinner.com/de/17
https://personal-loans-online.org/approval
http://www.no-credit-check-loan.net/approved
https://rolex-replica-shop.org/buy
http://fake-passport-documents.store/order
https://www.casino-winners-club.org/en/44
http://win-big-slots.net/de/8
https://bets-tips-free.org/today
http://www.cheap-meds-store.org/fr/2
https://free-gift-cards-generator.org/claim
http://xxx-cams-live.org/en/5
https://adult-club.org/en/2
http://adult-stories.net/fr/9
https://www.adult-shop.org/de/31
http://spam-mailer.net/en/6
https://adult-xxl.org/es/1
""".split()
ALLOWED_URLS = """
https://docs.python.org/3/library/json.html
https://en.wikipedia.org/wiki/Photosynthesis
https://gnu.org/licenses/gpl-3.0.html
https://postgresql.org/docs/current/tutorial.html
https://github.com/torvalds/linux/issues
https://stackoverflow.com/questions/11227809
https://www.nature.com/articles/d41586-020-00502
https://arxiv.org/abs/1706.03762
https://www.bbc.co.uk/news/science-environment
https://theguardian.com/books/2019/review
https://nasa.gov/missions/apollo
https://nps.gov/yell/planyourvisit
https://www.cdc.gov/flu/prevent
https://www.loc.gov/collections/maps
https://who.int/health-topics/malaria
https://un.org/en/about-us/history
https://europarl.europa.eu/portal/de
https://www.bundestag.de/parlament/geschichte
https://www.legifrance.gouv.fr/codes
https://stanford.edu/academics/departments
https://web.mit.edu/physics/research
https://cam.ac.uk/study-at-cambridge
https://uni-heidelberg.de/fakultaeten
https://www.louvre.fr/en/explore/collections
https://www.britishmuseum.org/visit/family
https://metmuseum.org/art/collection/search
https://mayoclinic.org/diseases-conditions/asthma
https://weather.gov/forecast/boston
https://www.allrecipes.com/recipe/sourdough-bread
https://www.seriouseats.com/how-to-cook-rice
https://goodreads.com/author/show/austen
https://gutenberg.org/ebooks/1342
https://imdb.com/title/tt0068646
https://www.allmusic.com/artist/miles-davis
https://www.chess.com/openings/sicilian
https://espn.com/soccer/standings
https://lonelyplanet.com/portugal/lisbon
https://openstreetmap.org/node/240109189
https://www.rfc-editor.org/rfc/rfc2616
https://developer.mozilla.org/en-US/docs/Web/CSS
https://www.w3.org/TR/html52/semantics
https://kubernetes.io/docs/concepts/overview
https://pkg.go.dev/net/http
https://news.ycombinator.com/item
https://forum.gardening-club.org/threads/pruning-roses
https://blog.alice-baker.net/2018/hiking-notes
http://smith-family.org/photos/summer
http://cityhall.springfield.example/council/minutes
https://stmarys-primary-school.org/calendar
https://riverside-bakery.com/menu
https://www.oakwood-dental.com/opening-hours
https://shop.fieldandforest.com/boots/walking
https://www.ikea.com/de/produkte/tische
https://lemonde.fr/culture/article
https://elpais.com/ciencia/2021
https://corriere.it/cronache
https://asahi.com/articles
https://archive.org/details/texts
https://www.jstor.org/stable/2346178
https://plato.stanford.edu/entries/kant
https://www.biology-letters.org/content/cells
https://historyextra.com/period/roman
https://bikeforums.net/touring/wheels
https://knitting-patterns.org/free-scarf
https://localbandmusic.com/concerts/tickets
https://status.cloudprovider.io/incidents
https://www.dw.com/en/57201
https://www.swissinfo.ch/de/4412
https://rfi.fr/fr/88102.html
https://blog.kulturhaus-wien.at/de/315
https://m.diario-local.es/es/22104
https://euronews.com/fr/2020/11/3
https://orf.at/de/9
http://blog.tommaso.it/en/4107.html
https://m.volkskrant.nl/en/13
http://www.iskolar.hu/de/2650
https://enontekio.fi/en/61
https://blog.nderitu.ke/fr/71990
http://www.shonan.jp/es/8
https://openlibrary.net/books/9
http://mathforum.net/geometry
https://railway-museum.net/visit
http://choir-of-leeds.net/concerts
https://sailing-club.net/regatta/results
https://lwn.net/articles/788
https://seattle-cyclists.net/en/routes
http://oldmaps.info/county/kent
https://www.debian.org/distrib/packages
https://www.libreoffice.org/download
https://www.openbsd.org/releases
https://www.oak-hill-school.org/staff
https://www.redcross.org/about-us
https://www.rotary-meetings.org/en/204
https://sternwarte.org/de/17
http://www.tennis-lyon.org/fr/6
https://juristen.org/es/3351
http://chemie-verein.net/de/480
https://teachers-union.org/news
https://ornithology.org/en/9921?utm_source=feed
https://blog.lutherie.org/en/118
http://m.astronomy.net/fr/77
https://hospital-info.info/wards
""".split()


def with_parts(urls: DataFrame, url: Column, host: str = "host", path: str = "path") -> DataFrame:
    """`urls` with the host in lower case and the path, under two new names."""
    after = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    rest = urls.withColumn(path, F.coalesce(after, F.lit("")))
    named = rest.withColumn(host, F.regexp_extract(path, "^[^/?#]*", 0))
    beyond = F.substr(F.col(path), F.char_length(F.col(host)) + 1)
    return named.withColumn(path, F.regexp_extract(beyond, "^[^?#]*", 0)).withColumn(
        host, F.translate(host, _UPPER, _UPPER.lower())
    )


def _longest(rules: list[Rule]) -> list[Rule]:
    return sorted(rules, key=lambda rule: (-len(rule.host + rule.path), -len(rule.host), rule))


def by_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(_longest(rules)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.host + rule.path)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def _with_slots(parts: DataFrame) -> DataFrame:
    """`parts` with the slot of each n-gram of host and path, `^` and `$` around them.

    Characters are taken apart once, so the work follows the length of a URL.
    """
    marked = F.concat(F.lit("^"), F.col("host"), F.col("path"), F.lit("$"))
    split = parts.withColumn("characters", F.split(marked, ""))
    characters = F.col("characters")

    def grams(n: int) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(characters) - n, F.lit(0)))
        return F.transform(
            starts,
            lambda i: F.pmod(
                F.xxhash64(*[F.get(characters, i + k) for k in range(n)]), F.lit(SLOTS)
            ).cast("int"),
        )

    return split.withColumn("slots", F.concat(*map(grams, GRAMS)))


def labelled(spark: SparkSession) -> DataFrame:
    rows = [(url, 1.0) for url in BLOCKED_URLS] + [(url, 0.0) for url in ALLOWED_URLS]
    return spark.createDataFrame(rows, "url string, label double")


def train(examples: DataFrame, penalty: float = 0.02) -> tuple[list[float], float]:
    """Weights by slot and intercept, from a small table (url, label: 1 to block).

    The feature of a slot is how many of a URL's n-grams fall into it. The table is taken in one
    partition, so that the sums, and with them the weights, come out the same each time.
    """
    parts = with_parts(examples.where("label IS NOT NULL"), F.col("url"))
    slots = _with_slots(parts).select("label", "slots")
    counts = F.transform(
        F.sequence(F.lit(0), F.lit(SLOTS - 1)),
        lambda slot: F.size(F.filter("slots", lambda x: x == slot)).cast("double"),
    )
    rows = slots.coalesce(1).select("label", array_to_vector(counts).alias("features"))
    learner = LogisticRegression(regParam=penalty, standardization=False, maxIter=60, tol=1e-7)
    model = learner.fit(rows)
    return [float(x) for x in model.coefficients], float(model.intercept)


def judge(
    pages: DataFrame, examples: DataFrame, id_column: str = "page_id", url_column: str = "url",
    rules: list[Rule] = RULES,
) -> DataFrame:
    """id, host, path, rule (null without one), verdict, and the score, 0 to 1, of each URL."""
    weights, intercept = train(examples)
    parts = with_parts(
        pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url")), F.col("url")
    )
    slots = _with_slots(parts)
    table = F.array(*map(F.lit, weights))
    logit = F.aggregate("slots", F.lit(intercept), lambda sum_, slot: sum_ + F.get(table, slot))
    scored = slots.withColumn("score", 1 / (1 + F.exp(-logit)))
    rule, verdict = by_rule(rules, F.col("host"), F.col("path"))
    method = F.when(F.col("score") >= CUT, BLOCK).otherwise(ALLOW)
    return scored.select(
        F.col("id").alias(id_column), "host", "path", rule.alias("rule"),
        F.coalesce(verdict, method).alias("verdict"), "score",
    )
