from __future__ import annotations

import random
import re

import pytest

from tallyhouse.llm import url_filter


def pages(spark, urls):
    rows = [(n, url, "<p>", "h", "r", 0.5) for n, url in enumerate(urls)]
    return spark.createDataFrame(
        rows, "page_id bigint, url string, html string, host string, rule string, score double"
    )


def plain(url):
    _, there, rest = (url or "").partition("://")
    if not there:
        return "", ""
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = [r for r in url_filter.RULES
            if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.host + r.path), default=None)


URLS = [
    None, "", "example.com/en/", "http://", "https://EXAMPLE.com/en/1", "http://www.example.com/en/1",
    "http://a.www.example.com/en/x?y#z", "http://notexample.com/en/", "http://x.example.com/EN/",
    "http://a.net/es/1", "http://a.net/fr", "http://net/fr/", "ftp://É.COM/", "http://a.org?x=/fr/",
    "http://a.org#b", "http://com", "http://spam-farm.example.org/de/1", "a://b://c.com/en/",
    "http://" + "a" * 50_000 + ".org/" + "b" * 50_000, "http://a\nb.org/c\nd", "http://a.org/é?x",
]


def random_urls(n):
    draw = random.Random(1)
    hosts = ["example.com", "www.example.com", "m.example.net", "net", "a.org", "COM", "x.Example.COM"]
    paths = ["/en/1", "/es/2", "/fr/", "/fr", "", "/", "/de/x", "?q=1", "#f", "/en"]
    return [f"{draw.choice(['http', 'https'])}://{draw.choice(hosts)}{draw.choice(paths)}" for _ in range(n)]


@pytest.fixture(scope="module")
def judged(spark):
    urls = URLS + random_urls(150)
    return urls, url_filter.judge(pages(spark, urls), url_filter.labelled(spark))


def test_host_path_and_rule(judged):
    urls, found = judged
    got = {r["page_id"]: r for r in found.collect()}
    assert len(got) == len(urls)
    for n, url in enumerate(urls):
        host, path = plain(url)
        rule = plain_rule(host, path)
        assert (got[n]["host"], got[n]["path"]) == (host, path), url
        assert got[n]["rule"] == (rule and rule.host + rule.path), url
        method = "block" if got[n]["score"] >= url_filter.CUT else "allow"
        assert got[n]["verdict"] == (rule.verdict if rule else method)


# URLs of general kinds that are not in the table, nor are their hosts.
UNSEEN_BLOCKED = """
https://grand-casino-online.co/register
http://poker-bonus-code.biz/deposit
https://adult-x.videos.example.org/clip/9
http://free-bets.example.net/today
https://spam-farm.example.org/en/728
http://cheap-pills.example.org/de/6
https://viagra-without-prescription.su/buy
http://instant-loan-approval.co/apply
https://bitcoin-doubler-profit.net/invest
http://win-free-iphone.club/claim
https://keygen-crack-download.org/photoshop
http://seo-backlinks-cheap.info/buy
https://verify-your-bank-login.top/secure
http://porn-videos-hd.mobi/watch
https://track.ad-clicks.info/banner
http://fake-rolex-replica.store/sale
""".split()
UNSEEN_ALLOWED = """
https://www.python.org/downloads
https://www.freebsd.org/releases
https://de.wikipedia.org/wiki/Heidelberg
https://www.nytimes.com/section/science
https://www.ox.ac.uk/admissions/undergraduate
https://spark.apache.org/docs/latest/sql-ref.html
https://www.nhs.uk/conditions/migraine
https://www.smithsonianmag.com/history
https://www.bibliotheque-nationale.fr/catalogue
https://www.green-valley-school.org/teachers
https://www.harbour-cafe.com/contact
https://blog.martin-fischer.de/2020/reise-notizen
https://www.rspb.org.uk/birds-and-wildlife
https://cran.r-project.org/web/packages
https://www.ecb.europa.eu/press/speeches
https://forum.woodworking.org/threads/chisels
""".split()


# Written after the table was done, and looked at once.
LATER_BLOCKED = """
https://vegas-jackpot-slots.co/spin
http://discount-cialis-pharmacy.su/cart
https://nude-cams-adult.me/room/3
http://easy-loans-today.co/apply
https://free-crypto-giveaway.live/claim
http://warez-keygen-hub.to/serial
https://secure-paypal-verify.info/login
http://replica-bags-cheap.store/louis
https://hookup-singles-local.com/join
http://popunder-adserver.click/track
""".split()
LATER_ALLOWED = """
https://numpy.org/doc/stable/user
https://fr.wikipedia.org/wiki/Lyon
https://www.princeton.edu/academics
https://www.amnesty.org/en/documents
https://birdwatchers-forum.net/threads/owls
https://www.cityofportland.gov/parks
https://villa-borghese-museo.it/en/visit
https://blog.emma-larsen.dk/2021/baking
https://physics-journal.org/articles/118
https://www.tate.org.uk/art/artists/turner
""".split()


def test_the_regression_learns_its_table_and_judges_other_kinds(spark):
    bad, good = [*UNSEEN_BLOCKED, *LATER_BLOCKED], [*UNSEEN_ALLOWED, *LATER_ALLOWED]
    urls = [*url_filter.BLOCKED_URLS, *url_filter.ALLOWED_URLS, *bad, *good]
    found = url_filter.judge(pages(spark, urls), url_filter.labelled(spark), rules=[])
    blocked = {urls[r["page_id"]] for r in found.collect() if r["verdict"] == "block"}
    assert blocked >= set(url_filter.BLOCKED_URLS)
    assert not blocked & set(url_filter.ALLOWED_URLS)
    caught, wronged = blocked & set(bad), blocked & set(good)
    assert len(caught) >= 0.8 * len(bad) and len(wronged) <= 0.1 * len(good)
    assert len(caught & set(LATER_BLOCKED)) >= 8 and len(wronged & set(LATER_ALLOWED)) <= 1
    known = {plain(u)[0] for u in (*url_filter.BLOCKED_URLS, *url_filter.ALLOWED_URLS)}
    assert not known & {plain(u)[0] for u in (*bad, *good)}


def test_no_python_on_the_way(judged):
    plan = judged[1]._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_no_rows(spark):
    assert url_filter.judge(pages(spark, []).limit(0), url_filter.labelled(spark)).collect() == []
