"""Families of real agent strings, told by hand."""

from stayline.operators import agents

WEBKIT = "AppleWebKit/537.36 (KHTML, like Gecko)"
SAFARI = "AppleWebKit/605.1.15 (KHTML, like Gecko)"
WINDOWS, MAC, LINUX = "(Windows NT 10.0; Win64; x64)", "(Macintosh; Intel Mac OS X 10_15_7)", "(X11; Linux x86_64)"
PHONE, TABLET = "(iPhone; CPU iPhone OS 16_5 like Mac OS X)", "(iPad; CPU OS 15_6 like Mac OS X)"
PIXEL = "(Linux; Android 13; Pixel 7)"

AGENTS = [
    (f"Mozilla/5.0 {WINDOWS} {WEBKIT} Chrome/114.0.0.0 Safari/537.36", "Windows", "Chrome"),
    (f"Mozilla/5.0 {MAC} {WEBKIT} Chrome/114.0.0.0 Safari/537.36", "Mac OS X", "Chrome"),
    (f"Mozilla/5.0 {LINUX} {WEBKIT} Chrome/114.0.0.0 Safari/537.36", "Linux", "Chrome"),
    (f"Mozilla/5.0 (X11; CrOS x86_64 14541.0.0) {WEBKIT} Chrome/114.0.0.0 Safari/537.36", "Chrome OS", "Chrome"),
    (f"Mozilla/5.0 (Windows NT 6.1; WOW64) {WEBKIT} Chrome/49.0.2623.112 Safari/537.36", "Windows", "Chrome"),
    (f"Mozilla/5.0 (Windows NT 5.1) {WEBKIT} Chrome/36.0.1985.143 Safari/537.36", "Windows", "Chrome"),
    (f"Mozilla/5.0 {PIXEL} {WEBKIT} Chrome/114.0.0.0 Mobile Safari/537.36", "Android", "Chrome Mobile"),
    (f"Mozilla/5.0 (Linux; Android 9; SM-T510) {WEBKIT} Chrome/96.0.4664.45 Safari/537.36", "Android", "Chrome"),
    (f"Mozilla/5.0 {PHONE} {SAFARI} CriOS/114.0.5735.99 Mobile/15E148 Safari/604.1", "iOS", "Chrome Mobile iOS"),
    (f"Mozilla/5.0 {TABLET} {SAFARI} CriOS/103.0.5060.63 Mobile/15E148 Safari/604.1", "iOS", "Chrome Mobile iOS"),
    (f"Mozilla/5.0 {PHONE} {SAFARI} Version/16.5 Mobile/15E148 Safari/604.1", "iOS", "Mobile Safari"),
    (f"Mozilla/5.0 {TABLET} {SAFARI} Version/15.6 Mobile/15E148 Safari/604.1", "iOS", "Mobile Safari"),
    (f"Mozilla/5.0 (iPod touch; CPU iPhone OS 12_5_5 like Mac OS X) {SAFARI} Version/12.1.2 Mobile/15E148 Safari/604.1", "iOS", "Mobile Safari"),
    (f"Mozilla/5.0 {MAC} {SAFARI} Version/16.5 Safari/605.1.15", "Mac OS X", "Safari"),
    ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_9_4) AppleWebKit/537.78.2 (KHTML, like Gecko) Version/7.0.6 Safari/537.78.2", "Mac OS X", "Safari"),
    ("Mozilla/5.0 (Windows; U; Windows NT 6.1) AppleWebKit/533.21.1 (KHTML, like Gecko) Version/5.0.5 Safari/533.21.1", "Windows", "Safari"),
    ("Mozilla/5.0 (Windows NT 10.0; Win64; x64; rv:109.0) Gecko/20100101 Firefox/115.0", "Windows", "Firefox"),
    ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10.15; rv:109.0) Gecko/20100101 Firefox/115.0", "Mac OS X", "Firefox"),
    ("Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:109.0) Gecko/20100101 Firefox/115.0", "Ubuntu", "Firefox"),
    ("Mozilla/5.0 (X11; Fedora; Linux x86_64; rv:60.0) Gecko/20100101 Firefox/60.0", "Linux", "Firefox"),
    ("Mozilla/5.0 (X11; Linux i686; rv:45.0) Gecko/20100101 Firefox/45.0", "Linux", "Firefox"),
    ("Mozilla/5.0 (Android 13; Mobile; rv:109.0) Gecko/114.0 Firefox/114.0", "Android", "Firefox Mobile"),
    (f"Mozilla/5.0 {PHONE} {SAFARI} FxiOS/114.0 Mobile/15E148 Safari/605.1.15", "iOS", "Firefox iOS"),
    (f"Mozilla/5.0 {TABLET} {SAFARI} FxiOS/102.0 Mobile/15E148 Safari/605.1.15", "iOS", "Firefox iOS"),
    (f"Mozilla/5.0 {WINDOWS} {WEBKIT} Chrome/114.0.0.0 Safari/537.36 Edg/114.0.1823.51", "Windows", "Edge"),
    (f"Mozilla/5.0 {MAC} {WEBKIT} Chrome/114.0.0.0 Safari/537.36 Edg/114.0.1823.51", "Mac OS X", "Edge"),
    (f"Mozilla/5.0 {WINDOWS} {WEBKIT} Chrome/46.0.2486.0 Safari/537.36 Edge/13.10586", "Windows", "Edge"),
    (f"Mozilla/5.0 {PIXEL} {WEBKIT} Chrome/113.0.0.0 Mobile Safari/537.36 EdgA/113.0.1774.63", "Android", "Edge"),
    (f"Mozilla/5.0 {PHONE} {SAFARI} Version/16.0 EdgiOS/113.0.1774.50 Mobile/15E148 Safari/605.1.15", "iOS", "Edge"),
    (f"Mozilla/5.0 {WINDOWS} {WEBKIT} Chrome/113.0.0.0 Safari/537.36 OPR/99.0.0.0", "Windows", "Opera"),
    (f"Mozilla/5.0 {PIXEL} {WEBKIT} Chrome/113.0.0.0 Mobile Safari/537.36 OPR/75.3.0", "Android", "Opera"),
    ("Opera/9.80 (Windows NT 6.1; WOW64) Presto/2.12.388 Version/12.18", "Windows", "Opera"),
    ("Opera/9.80 (X11; Linux i686) Presto/2.12.388 Version/12.16", "Linux", "Opera"),
    (f"Mozilla/5.0 {LINUX} {WEBKIT} Ubuntu Chromium/80.0.3987.87 Chrome/80.0.3987.87 Safari/537.36", "Ubuntu", "Chromium"),
    ("Mozilla/5.0 (Windows NT 6.3; WOW64; Trident/7.0; rv:11.0) like Gecko", "Windows", "IE"),
    ("Mozilla/4.0 (compatible; MSIE 8.0; Windows NT 6.0; Trident/4.0)", "Windows", "IE"),
    ("Mozilla/5.0 (compatible; MSIE 9.0; Windows NT 6.1; WOW64; Trident/5.0)", "Windows", "IE"),
    ("Mozilla/5.0 (compatible; MSIE 10.0; Windows Phone 8.0; Trident/6.0; IEMobile/10.0; NOKIA; Lumia 920)", "Windows Phone", "IE"),
    (f"Mozilla/5.0 (Windows Phone 10.0; Android 6.0.1; Microsoft; Lumia 950) {WEBKIT} Chrome/52.0.2743.116 Mobile Safari/537.36 Edge/15.15063", "Windows Phone", "Edge"),
    ("Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)", "Other", "Other"),
    ("curl/7.88.1", "Other", "Other"),
    ("", "Unknown", "Unknown"),
    (None, "Unknown", "Unknown"),
]


def test_families_of_agents(spark):
    table = spark.createDataFrame([(a,) for a, _, _ in AGENTS], "userAgent string")
    found = {r.userAgent: (r.os, r.browser) for r in agents.agent_families(table).collect()}
    assert len(AGENTS) >= 40 and found == {a: (system, browser) for a, system, browser in AGENTS}
