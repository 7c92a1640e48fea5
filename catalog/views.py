"""Views over the given tables, in SQL that Spark and DuckDB read alike."""

from __future__ import annotations

import re

AS_OF = "2024-12-31"

TABLES = ["documents", "pages", "events", "customer", "supplier", "nation"]

VIEWS = {
    "v_policies": """
SELECT doc_id AS id,
 concat('https://www.', source, '.example.org/art/', CAST(doc_id AS STRING), '.html') AS source_url,
 concat(CASE WHEN doc_id % 17 = 0 THEN '关于废止' ELSE '' END, split_part(text, chr(10), 1)) AS title,
 CASE WHEN doc_id % 5 = 0 THEN '' ELSE concat(source, '〔', CAST(2020 + doc_id % 6 AS STRING), '〕', CAST(doc_id AS STRING), '号') END AS doc_number,
 source AS issuing_authority,
 DATE '2024-01-01' + CAST(doc_id % 730 AS INT) AS publish_date,
 concat(text, CASE doc_id % 10 WHEN 1 THEN ' 联系 13812345678 。' WHEN 2 THEN ' 证号 110101199001011234 。' WHEN 3 THEN ' 电话 010-12345678 。' ELSE '' END,
   CASE doc_id % 6 WHEN 0 THEN '国家集采' WHEN 1 THEN ' GSP ' WHEN 2 THEN '药品追溯码' ELSE '' END) AS content,
 concat('["', lang, '"]') AS tags,
 CASE WHEN doc_id % 17 = 0 THEN '废止' WHEN doc_id % 730 > 365 THEN '未生效' ELSE '有效' END AS validity_status,
 CAST(DATE '2024-12-01' + CAST(doc_id % 31 AS INT) AS TIMESTAMP) AS created_at
 FROM documents""",
    "v_stored": """
SELECT id, source_url, title, content, doc_number, created_at, created_at AS updated_at FROM v_policies WHERE id % 4 <> 0
 UNION ALL SELECT id + 5000000000, replace(source_url, '/art/', '/old/'), title, content, doc_number, created_at, created_at FROM v_policies""",
    "v_incoming": """
SELECT doc_id AS seq, concat('https://www.', source, '.example.org/art/', CAST(doc_id AS STRING), '.html') AS source_url,
 CASE WHEN doc_id % 21 = 0 THEN NULL ELSE concat('新 ', CAST(doc_id AS STRING)) END AS title, text AS content, 'n' AS doc_number FROM documents
 UNION ALL SELECT doc_id + 1000000000, concat('https://www.', source, '.example.org/art/', CAST(doc_id AS STRING), '.html'),
 concat('再 ', CAST(doc_id AS STRING)), 'v2', 'm' FROM documents WHERE doc_id % 9 = 0""",
    "v_list_pages": """
SELECT id AS page_id, issuing_authority AS source, 'https://www.example.org/col/index.html' AS base,
 concat('<ul><li><span>2024-00-00012</span><a class="t" href="/art/', CAST(id AS STRING), '.html">', title, '</a><span>', CAST(publish_date AS STRING), '</span></li><li><a href="/more.html">更多内容</a></li>',
 '<li><a href="/col/', CAST(id AS STRING), '.shtml">短</a></li><li>no link 2024-01-01</li><li><span>2024年3月7日</span> <a href="../doc/', CAST(id AS STRING), '.htm">文件 ', CAST(id AS STRING), '</a></li></ul>') AS html FROM v_policies""",
    "v_document_pages": """
SELECT id AS page_id, CASE id % 3 WHEN 0 THEN 'nmpa' WHEN 1 THEN 'nhsa' ELSE 'nhc' END AS source, source_url AS url,
 CASE id % 3
 WHEN 0 THEN concat('<html><head><title>页 ', CAST(id AS STRING), '</title></head><body>', CASE WHEN id % 2 = 0 THEN concat('<h1> 标题 ', CAST(id AS STRING), '</h1>') ELSE '<h1> </h1>' END,
   '<p>发布时间：', CAST(2020 + id % 5 AS STRING), '年', CAST(1 + id % 12 AS STRING), '月', CAST(1 + id % 28 AS STRING), '日</p>',
   CASE WHEN id % 4 = 0 THEN '<div class="text">短</div>' ELSE '' END, '<div id="zoom"><p>', replace(content, chr(10), '</p><p>'), '</p><p>', doc_number, '</p></div>')
 WHEN 1 THEN concat('<html><head><title>页 ', CAST(id AS STRING), '</title></head><body>', CASE WHEN id % 2 = 0 THEN concat('<!--<$[标题]>begin-->字段 ', CAST(id AS STRING), '<!--<$[标题]>end-->') ELSE concat('<h1>标题 ', CAST(id AS STRING), '</h1>') END,
   '<span>发布日期</span> <b>', CAST(publish_date AS STRING), '</b><span>发布机构：</span> <span class="v">', issuing_authority, ' 局</span>',
   CASE WHEN id % 5 = 0 THEN '<!--<$[引题]>begin-->引〔2024〕1号<!--<$[引题]>end-->' ELSE '' END,
   '<!--<$[信息内容]>begin--><p>', content, '</p>', doc_number, '<!--<$[信息内容]>end-->')
 ELSE concat('<html><head><meta name="ArticleTitle" content="', CASE WHEN id % 2 = 0 THEN concat(' 元 ', CAST(id AS STRING), ' ') ELSE '' END, '"><title>页 ', CAST(id AS STRING), '</title></head><body><div class="tit">框 ', CAST(id AS STRING), '</div>',
   '<p>时间: ', CAST(publish_date AS STRING), '</p><p>来源：', chr(10), ' ', issuing_authority, '</p><div id="xw_box">', content, ' ', doc_number, '</div>')
 END ||
 concat('<a class="f" href="./att/', CAST(id AS STRING), '.pdf">f</a><a href="/d/downfile.jsp?a=1&amp;b=', CAST(id AS STRING), '">d</a><a href="./att/', CAST(id AS STRING), '.pdf">again</a>',
 '<img alt="" src="../img/', CAST(id % 7 AS STRING), '.png"><img src="//cdn.example.org/', CAST(id AS STRING), '.gif"></body></html>') AS html
 FROM v_policies""",
    "v_attachment_text": """
SELECT concat('https://a.example.org/', CAST(doc_id AS STRING), '.pdf') AS url, 'doc' AS kind, concat('  附 ', CAST(doc_id AS STRING), ' ') AS text FROM documents WHERE doc_id % 3 <> 0
 UNION ALL SELECT concat('https://a.example.org/', CAST(doc_id AS STRING), '.docx'), 'doc', concat('W', CAST(doc_id AS STRING)) FROM documents WHERE doc_id % 2 = 0
 UNION ALL SELECT concat('https://a.example.org/', CAST(doc_id AS STRING), '.png'), 'image', CASE WHEN doc_id % 5 = 0 THEN ' ' ELSE concat('图 ', CAST(doc_id AS STRING)) END FROM documents""",
    "v_request_log": """
SELECT concat(CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) AS run_id, event_id AS seq,
 concat('https://h', CAST(user_id % 20 AS STRING), '.example.org/p/', CAST(event_id % 3 AS STRING)) AS url,
 CASE event_type WHEN 'error' THEN 403 WHEN 'signup' THEN 0 WHEN 'purchase' THEN 412 ELSE 200 END AS status, value AS elapsed, ts FROM events""",
    "v_robots": """
SELECT concat('h', CAST(user_id AS STRING), '.example.org') AS host,
 CASE user_id % 3 WHEN 0 THEN concat('User-agent: *', chr(10), 'Disallow: /p', chr(10), 'Allow: /p/1', chr(10))
  WHEN 1 THEN concat('User-agent: other', chr(10), 'Disallow: /p/0', chr(10), '# c', chr(10), 'User-agent: *', chr(10), 'Disallow: /p/2', chr(10))
  ELSE concat('User-agent: *', chr(10), 'Allow: /', chr(10), 'User-agent: other', chr(10), 'Disallow: /', chr(10)) END AS body
 FROM (SELECT DISTINCT user_id % 20 AS user_id FROM events) x WHERE user_id < 18""",
    "v_feed": """
SELECT CASE WHEN doc_id % 11 = 0 THEN '' ELSE concat('p_old', CAST(doc_id AS STRING)) END AS id, concat('旧 ', CAST(doc_id AS STRING)) AS title,
 concat('https://www.', source, CASE WHEN doc_id % 7 = 0 THEN '.example.org/old/' ELSE '.example.org/art/' END, CAST(doc_id - doc_id % 2 AS STRING), '.html') AS url,
 CASE WHEN doc_id % 13 = 0 THEN '' ELSE CAST(DATE '2024-01-01' + CAST(doc_id % 50 AS INT) AS STRING) END AS publish_date,
 substr(text, 1, 200) AS content_preview, source AS source_site, '2024-06-01T00:00:00' AS created_at, doc_id AS pos FROM documents WHERE doc_id % 4 <> 0""",
    "v_feed_incoming": """
SELECT seq, CASE WHEN seq % 10 = 0 THEN '  ' ELSE source_url END AS source_url, title, content, 'site ' AS issuing_authority,
 CAST(DATE '2024-02-01' + CAST(seq % 20 AS INT) AS STRING) AS publish_date FROM v_incoming""",
    "v_navigation": """
SELECT CASE c_custkey % 4 WHEN 0 THEN '医保局' WHEN 1 THEN '药监局' WHEN 2 THEN '卫健委' ELSE '其他' END AS category, c_custkey AS pos, c_name AS name,
 CASE c_nationkey WHEN 0 THEN '国家' WHEN 1 THEN '北京市' WHEN 2 THEN '湖南省' WHEN 3 THEN '' WHEN 4 THEN '内蒙古自治区' ELSE n_name END AS area,
 CASE WHEN c_custkey % 10 = 0 THEN '' ELSE concat('http://p', CAST(c_custkey % 900 AS STRING), '.gov.cn', CASE WHEN c_custkey % 2 = 0 THEN '/' ELSE '' END) END AS portal_url
 FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "v_sources": """
SELECT DISTINCT source AS id, concat('机构 ', source) AS name, concat('https://h', substr(source, 4), '.example.org/p/1') AS list_url,
 CAST(substr(source, 4) AS INT) % 3 <> 0 AS enabled FROM documents""",
}


def _needed(sql: str) -> list[str]:
    """Views a query names, with those they name, in the order they must be defined."""
    names: list[str] = []
    for name in VIEWS:
        if re.search(rf"\b{name}\b", sql):
            for inner in [*_needed(VIEWS[name]), name]:
                if inner not in names:
                    names.append(inner)
    return names


def cte(sql: str) -> str:
    """``sql`` with the views it names in front of it."""
    sql = sql.strip()
    names = _needed(sql)
    if not names:
        return sql
    views = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in names)
    if sql.upper().startswith("WITH "):
        return f"WITH {views},\n{sql[5:]}"
    return f"WITH {views}\n{sql}"
