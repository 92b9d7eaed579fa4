"""Values that results depend on literally."""

# Mail domain -> provider.
EMAIL_PROVIDERS = {
    "gmail": "google",
    "att.net": "att",
    "twc.com": "spectrum",
    "scranton.edu": "other",
    "optonline.net": "other",
    "hotmail.co.uk": "microsoft",
    "comcast.net": "other",
    "yahoo.com.mx": "yahoo",
    "yahoo.fr": "yahoo",
    "yahoo.es": "yahoo",
    "charter.net": "spectrum",
    "live.com": "microsoft",
    "aim.com": "aol",
    "hotmail.de": "microsoft",
    "centurylink.net": "centurylink",
    "gmail.com": "google",
    "me.com": "apple",
    "earthlink.net": "other",
    "gmx.de": "other",
    "web.de": "other",
    "cfl.rr.com": "other",
    "hotmail.com": "microsoft",
    "protonmail.com": "other",
    "hotmail.fr": "microsoft",
    "windstream.net": "other",
    "outlook.es": "microsoft",
    "yahoo.co.jp": "yahoo",
    "yahoo.de": "yahoo",
    "servicios-ta.com": "other",
    "netzero.net": "other",
    "suddenlink.net": "other",
    "roadrunner.com": "other",
    "sc.rr.com": "other",
    "live.fr": "microsoft",
    "verizon.net": "yahoo",
    "msn.com": "microsoft",
    "q.com": "centurylink",
    "prodigy.net.mx": "att",
    "frontier.com": "yahoo",
    "anonymous.com": "other",
    "rocketmail.com": "yahoo",
    "sbcglobal.net": "att",
    "frontiernet.net": "yahoo",
    "ymail.com": "yahoo",
    "outlook.com": "microsoft",
    "mail.com": "other",
    "bellsouth.net": "other",
    "embarqmail.com": "centurylink",
    "cableone.net": "other",
    "hotmail.es": "microsoft",
    "mac.com": "apple",
    "yahoo.co.uk": "yahoo",
    "netzero.com": "other",
    "yahoo.com": "yahoo",
    "live.com.mx": "microsoft",
    "ptd.net": "other",
    "cox.net": "other",
    "aol.com": "aol",
    "juno.com": "other",
    "icloud.com": "apple",
}

# Suffixes counted as the United States.
US_SUFFIXES = ("gmail", "net", "edu")

# Device name fragment -> brand, first match wins.
DEVICE_BRANDS = (
    ("SM", "Samsung"),
    ("SAMSUNG", "Samsung"),
    ("GT-", "Samsung"),
    ("Moto G", "Motorola"),
    ("Moto", "Motorola"),
    ("moto", "Motorola"),
    ("LG-", "LG"),
    ("rv:", "RV"),
    ("HUAWEI", "Huawei"),
    ("ALE-", "Huawei"),
    ("-L", "Huawei"),
    ("Blade", "ZTE"),
    ("BLADE", "ZTE"),
    ("Linux", "Linux"),
    ("XT", "Sony"),
    ("HTC", "HTC"),
    ("ASUS", "Asus"),
)

# Category -> code of the identity columns.
TRUE_FALSE = {"T": 1, "F": 0}
FOUND = {"Found": 1, "NotFound": 0}
NEW_FOUND_UNKNOWN = {"New": 2, "Found": 1, "Unknown": 0}
NEW_FOUND = {"New": 2, "Found": 1}
PROXY_CLASS = {"TRANSPARENT": 4, "IP_PROXY": 3, "IP_PROXY:ANONYMOUS": 2, "IP_PROXY:HIDDEN": 1}

# United States federal holidays, 2017-10-01 to 2019-01-01, as observed.
US_HOLIDAYS = (
    "2017-10-09",
    "2017-11-10",
    "2017-11-23",
    "2017-12-25",
    "2018-01-01",
    "2018-01-15",
    "2018-02-19",
    "2018-05-28",
    "2018-07-04",
    "2018-09-03",
    "2018-10-08",
    "2018-11-12",
    "2018-11-22",
    "2018-12-25",
    "2019-01-01",
)

# Day from which transaction seconds are counted, text for a missing label, and
# the number that stands for any missing feature.
ORIGIN = "2017-11-30"
UNSEEN_LABEL = "unseen_before_label"
MISSING_FEATURE = -10000.0
