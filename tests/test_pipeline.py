import http.server
import itertools
import json
import threading
import zipfile

from sanadflow.plans.extract import extract
from sanadflow.sources import editions, web
from sanadflow.sources.collections import read_verdicts

NARRATION = "حدثنا زيد بن عمر عن خالد قال سمعت {} يقول رسول الله {} الوضوء والصلاه في المسجد الجامع يوم الجمعه"


def body(n, dup=False):
    lines = ["#META# 020.BookTITLE :: Title", "#META#Header#End#"]
    lines += [f"# {i} " + NARRATION.format(f"بكر{chr(0x628 + i) * 4}", " ".join(chr(0x628 + i + k) * 5 for k in range(6))) for i in range(1, n + 1)]
    if dup:
        lines.append(f"# {n + 1} " + lines[2].split(" ", 2)[2] + " زياده")
    return "\n".join(lines)


def test_archive_to_narrations(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "r.zip", "w") as z:
        z.writestr("r/data/Auth/Auth.Work/Auth.Work.Ed1", body(3, dup=True))
        z.writestr("r/data/Auth/Auth.Work/Auth.Work.Ed2", "x" * 4000)
        z.writestr("r/data/Auth/Auth.Work/Auth.Work.Ed2.yml", body(9))
        z.writestr("r/data/Else/Else.Book/Else.Book.Ed1", "no entries")
    (tmp_path / "broken.zip").write_bytes(b"not a zip")
    files = editions.read_archives(spark, str(tmp_path))
    assert files.where("error is not null").count() == 1
    files = files.where("error is null").cache()
    assert [(r.author, r.work) for r in editions.catalogue(files).collect()] == [("Auth", "Auth.Work"), ("Else", "Else.Book")]
    works = spark.createDataFrame([("Auth.Work", "A"), ("Else.Book", "B"), ("Gone.Book", "C")], "fragment string, title string")
    lexicon = spark.createDataFrame([("Prayer", 0, "والصلاه"), ("Mosque", 1, "المسجد")], "topic string, topic_ord int, keyword string")
    rows, summary = extract(files, works, lexicon)
    got = {r.title: (r.status, r.parsed, r.attributed, r.uniq) for r in summary.collect()}
    assert got["B"][0] == "no entries" and got["C"] == ("no file", 0, 0, 0) and got["A"][:3] == ("built", 4, 4)
    rows = rows.orderBy("ord").collect()
    assert sum(1 + r.dups for r in rows) == 4 and rows[0].dups >= 1 and "Prayer" in rows[0].topics


class Pages(http.server.BaseHTTPRequestHandler):
    asked = []

    def do_GET(self):
        self.asked.append(self.path)
        if len(self.asked) == 1:
            self.send_error(429)
            return
        data = [{"hadith": "t", "grade": "g"}] if "page=1" in self.path else []
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps({"data": data}).encode())

    def log_message(self, *_):
        pass


def test_paged_source(spark):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/"
    waits = []
    assert web.get_json(url, {"page": 1}, sleep=waits.append) == {"data": [{"hadith": "t", "grade": "g"}]} and waits == [6.0]
    assert web.get_json("http://127.0.0.1:9/", retries=3, sleep=waits.append) is None and waits == [6.0, 1.0, 2.0]
    spark.dataSource.register(web.PagedJson)
    rows = spark.read.format("paged_json").options(url=url, queries="a\nb", pages="3", delay="0.5").load()
    got = rows.collect()
    server.shutdown()
    assert [(r.query, r.page) for r in got] == [("a", 1), ("b", 1)]
    answers = spark.createDataFrame(got, rows.schema)
    assert read_verdicts(answers, "answer").count() == 2


def unlike_rare_words(spark):
    words = ["".join(w) for w in itertools.product("بتجحدرسش", repeat=4)]
    said = "حدثنا زيد قال سمعت عمر يقول قال رسول الله"
    lines = [f"# {i} {said} {' '.join(words[:20])} {' '.join(words[100 * i : 100 * i + 7])}" for i in (1, 2, 3)]
    files = spark.createDataFrame([("Auth.Work.Ed1", 1, "\n".join(["#META#Header#End#", *lines]))], "path string, size long, raw string")
    works = spark.createDataFrame([("Auth.Work", "A")], "fragment string, title string")
    return extract(files, works, spark.createDataFrame([], "topic string, topic_ord int, keyword string"))


def test_extracted_rows_are_merged_where_their_rarest_words_differ(spark):
    assert [(r.title, r.ord, r.dups) for r in unlike_rare_words(spark)[0].collect()] == [("A", 1, 2)]


def test_summary_counts_no_record_twice_where_their_rarest_words_differ(spark):
    assert [(r.title, r.status, r.attributed, r.uniq) for r in unlike_rare_words(spark)[1].collect()] == [("A", "built", 3, 1)]
