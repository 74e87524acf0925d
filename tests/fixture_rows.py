"""Hand-made snapshots that hit the edges of every cleaning rule."""

STORE = [
    (10, "$1,299.99", "4799,99zł", "21 Aug, 2012",
     "English<strong>*</strong>, French, German<br><strong>*</strong>languages with full audio support", "Action, Free To Play"),
    (10, "$5.00", "19,99zł", "1 Jan, 2000", "Polish", "RPG"),
    (20, None, None, "Coming soon", None, None),
    (30, "Free", "Free", "1 Jul, 2013", "English, #lang_slovakian", "Free to Play, Massively Multiplayer"),
    (40, "4-5", "1 299,99zł", "Aug 21, 2012", " ,English<strong>*</strong>,english", "Indie,,RPG"),
    (50, "-3", "-3,50zł", None, "<b>Polish</b>\u00a0*", "Utilities"),
]

# appid, name, positive, negative, ccu, owners
POPULARITY = [
    (10, "Alpha", 300, 100, 100, "10,000,000 .. 20,000,000"),
    (10, "Alpha", 310, 100, 250, "10,000,000 .. 20,000,000"),
    (20, "Beta", 0, 0, -1, "1,000,000 .. 2,000,000"),
    (30, "Gamma", 5, -2, None, "200,000,000 .. "),
]


def write_csv(path, header, records):
    import csv

    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f)
        writer.writerow(header)
        writer.writerows([["" if v is None else v for v in r] for r in records])


def store_csv(path, records=STORE):
    write_csv(path, ["appid", "price_usd", "price_pln", "release_date", "languages", "genre"], records)


def popularity_csv(path, records=POPULARITY):
    header = [
        "appid", "name", "developer", "publisher", "score_rank", "positive", "negative", "userscore", "owners",
        "average_forever", "average_2weeks", "median_forever", "median_2weeks", "price", "initialprice", "discount", "ccu",
    ]
    full = [(a, n, "d", "p", None, pos, neg, 0, own, 0, 0, 0, 0, "0", "0", "0", ccu) for a, n, pos, neg, ccu, own in records]
    write_csv(path, header, full)
