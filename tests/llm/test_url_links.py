"""The url query against its SQL on pages that link to other hosts: cycles, hubs, chains, links without a scheme, relative links."""

import random

from oracle import difference

from tarnwater.llm.queries import ORACLE, QUERIES


def test_linked_pages_equal_sql(spark, tmp_path):
    draw = random.Random(4)
    hosts = [f"h{i}.test" for i in range(40)] + [f"Spam{i}.net" for i in range(4)] + ["a.example.com", "b.example.com", "paper.org", "deep.sub.paper.org", "hub.test"]
    rows = []
    for i in range(400):
        host = draw.choice(hosts)
        links = [draw.choice(['<a HREF="https://{}/x">', "<a href=//{}>", "<a  href='http://{}?q'>", '<a href="/local/{}">']).format(draw.choice(hosts)) for _ in range(draw.randrange(4))]
        rows.append((f"https://{host}/{draw.choice(['', 'de/', 'fr/', 'en/x'])}{i}", " ".join(links)))
    rows.append(("http://hub.test/", " ".join(f'<a href="http://{h}/">' for h in hosts)))
    rows += [(f"http://c{i}.chain/", f'<a href="http://c{i + 1}.chain/">') for i in range(25)] + [("http://c25.chain/", '<a href="http://spam0.net/"><a href="http://c0.chain">')]
    rows += [(f"http://ring{i}.test/", f'<a href="//ring{(i + 1) % 5}.test/">') for i in range(5)] + [(None, "<a href=//h1.test>"), ("no scheme", None)]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id bigint, url string, html string")
    pages.coalesce(1).write.parquet(f"{tmp_path}/written")
    (part,) = (tmp_path / "written").glob("*.parquet")
    part.rename(tmp_path / "pages.parquet")
    found = QUERIES["op8_url_filter"](spark, str(tmp_path))
    assert difference(found, str(tmp_path), ORACLE["op8_url_filter"]) is None
    verdicts = {r.host: r.verdict for r in found.where("rule IS NULL").collect()}
    assert {verdicts[f"c{i}.chain"] for i in range(26)} == {"block"} and verdicts["ring0.test"] == "allow"
