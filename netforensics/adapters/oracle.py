"""Equivalent SQL (DuckDB dialect) for the registered queries, over the same test tables.

Each statement repeats its adapter as common table expressions and then states the rule of the
operator as plain relational SQL.
"""

from __future__ import annotations

from netforensics import vocab


def _list(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


def address(key: str) -> str:
    return (
        f"CASE WHEN {key} % 11 = 0 THEN concat('192.168.', ({key} // 250) % 250, '.', {key} % 250 + 1) "
        f"ELSE concat('203.', ({key} // 62500) % 250, '.', ({key} // 250) % 250, '.', {key} % 250 + 1) END"
    )


def rnd(value: str, digits: int) -> str:
    return f"round_even(({value}) * {10 ** digits}.0, 0) / {10 ** digits}.0"


def ent(text: str) -> str:
    share = f"((length({text}) - length(replace({text}, ch, ''))) / length({text})::DOUBLE)"
    return f"list_sum(list_transform(list_distinct(string_split({text}, '')), lambda ch: -{share} * log2({share})))"


def registered(name: str) -> str:
    return f"array_to_string(string_split({name}, '.')[-2:], '.')"


def subdomain(name: str) -> str:
    return f"array_to_string(string_split({name}, '.')[:-3], '.')"


def suffixes(name: str, minimum: int = 1) -> str:
    labels = f"string_split({name}, '.')"
    return f"list_transform(range(1, len({labels}) + {2 - minimum}), lambda i: array_to_string({labels}[i:], '.'))"


def clean(name: str) -> str:
    return f"rtrim(lower({name}), '.')"


def private(ip: str) -> str:
    return f"({ip} LIKE '192.168.%' OR {ip} LIKE '10.%')"


def technique(kind: str) -> str:
    return "CASE " + kind + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in vocab.KIND_TECHNIQUE.items()) + " END"


CTE: dict[str, str] = {}
HOST = r"regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)"

CTE["conn"] = f"""conn AS (
  SELECT concat('case-', l_orderkey % 7) AS case_id, l_orderkey * 8 + l_linenumber AS seq, epoch(l_shipdate) AS ts,
    concat('10.0.0.', l_orderkey % 200 + 1) AS src_ip, {address('l_orderkey')} AS dst_ip, 443 AS dst_port,
    (l_quantity * 1000)::BIGINT AS orig_bytes,
    CASE WHEN l_orderkey % 13 = 0 THEN 0 ELSE floor(l_extendedprice)::BIGINT END AS resp_bytes,
    CASE WHEN l_linestatus = 'O' AND l_orderkey % 13 <> 0 THEN 'Sh' ELSE 'S' END AS history,
    CASE l_returnflag WHEN 'R' THEN 'POST' WHEN 'A' THEN 'GET' END AS http_method,
    CASE WHEN l_returnflag <> 'N' THEN concat('Host', l_suppkey % 97, '.example.com:8080') END AS http_host,
    CASE l_returnflag WHEN 'R' THEN concat('/gate.php?item=', l_partkey) WHEN 'A' THEN '/index.html' END AS http_uri,
    CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN concat('STOR part', l_partkey, '.zip') END AS ftp_upload_cmd
  FROM lineitem),
pub AS (SELECT *, CASE WHEN orig_bytes + resp_bytes > 0 THEN orig_bytes / (orig_bytes + resp_bytes)::DOUBLE ELSE 0 END AS ratio
  FROM conn WHERE NOT {private('dst_ip')})"""

CTE["sess"] = f"""sess AS (
  SELECT concat('case-', l_orderkey % 7) AS case_id, l_orderkey * 8 + l_linenumber AS seq, epoch(l_shipdate) AS ts,
    concat('10.0.0.', l_orderkey % 200 + 1) AS src_ip, 40000 + l_linenumber AS src_port, {address('l_orderkey')} AS dst_ip,
    443 AS dst_port, 'tcp' AS proto, (l_quantity * 1000)::BIGINT AS orig_bytes, floor(l_extendedprice)::BIGINT AS resp_bytes,
    CASE WHEN l_linestatus = 'O' THEN 'Sh' ELSE 'S' END AS history,
    CASE WHEN l_linestatus = 'O' THEN concat('C', l_orderkey, '-', l_linenumber) END AS uid FROM lineitem)"""

CTE["ohttp"] = f"""ohttp AS (
  SELECT concat('case-', o_orderkey % 7) AS case_id, o_orderkey AS seq, epoch(o_orderdate) AS ts,
    concat('10.0.0.', o_orderkey % 200 + 1) AS src_ip, {address('o_orderkey')} AS dst_ip,
    CASE WHEN o_orderkey % 3 = 0 THEN 8081 ELSE 443 END AS dst_port,
    CASE WHEN o_orderstatus = 'P' THEN 'POST' ELSE 'GET' END AS method, concat('cust', o_custkey % 50, '.example.net') AS host,
    concat('/o/', o_orderkey) AS uri, CASE WHEN o_orderstatus = 'O' THEN concat('C', o_orderkey, '-1') END AS uid FROM orders)"""

CTE["oftp"] = f"""oftp AS (
  SELECT concat('case-', o_orderkey % 7) AS case_id, o_orderkey AS seq, epoch(o_orderdate) AS ts, concat('10.0.0.', o_orderkey % 200 + 1) AS src_ip,
    {address('o_orderkey')} AS dst_ip,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'STOR' WHEN '2' THEN 'appe' ELSE 'RETR' END AS command,
    concat('doc', o_custkey, '.zip') AS arg, CASE WHEN o_orderstatus = 'O' THEN concat('C', o_orderkey, '-2') END AS uid
  FROM orders)"""

CTE["dns"] = f"""dns AS (
  SELECT concat('case-', event_id % 7) AS case_id, event_id * 2 AS seq, epoch(ts) AS ts, concat('10.0.0.', user_id % 200 + 1) AS src_ip,
    concat('10.0.1.', 53 + user_id % 3) AS dst_ip,
    CASE event_type WHEN 'error' THEN concat(md5(event_id::VARCHAR), '.com')
      WHEN 'purchase' THEN concat(md5(event_id::VARCHAR), '.t', user_id % 5, '-update.com')
      WHEN 'view' THEN concat('WWW.Site', user_id, '.com') WHEN 'click' THEN 'v10.events.data.microsoft.com'
      ELSE 'drive.google.com' END AS query,
    CASE WHEN event_type = 'purchase' THEN 'TXT' ELSE 'A' END AS qtype,
    CASE WHEN event_type = 'error' THEN 'NXDOMAIN' ELSE 'NOERROR' END AS rcode FROM events
  UNION ALL
  SELECT concat('case-', page_id % 7), page_id * 2 + 1, 1704067200.0 + page_id, concat('10.0.0.', page_id % 200 + 1), '10.0.1.53', {HOST}, 'A',
    'NOERROR' FROM pages)"""

CTE["tunnel"] = f"""q AS (SELECT *, {registered('query')} AS domain, {subdomain('query')} AS sub FROM dns),
stat AS (
  SELECT case_id, domain, count(*) AS n, count(*) FILTER (sub <> '') AS sn,
    avg({ent('sub')}) FILTER (sub <> '') AS e, avg(length(sub)) FILTER (sub <> '') AS l,
    count(*) FILTER (upper(qtype) IN ({_list(vocab.TUNNEL_RECORD_TYPES)})) / count(*)::DOUBLE AS rt,
    count(DISTINCT sub) FILTER (sub <> '') / count(*)::DOUBLE AS u,
    count(*) FILTER (rcode = 'NXDOMAIN') / count(*)::DOUBLE AS nx
  FROM q GROUP BY 1, 2 HAVING count(*) >= 5 AND count(*) FILTER (sub <> '') > 0),
scored AS (
  SELECT *, (e >= 3.2)::INT + (l >= 20)::INT + 2 * (rt >= 0.5)::INT + (n >= 50 AND u >= 0.5)::INT AS score FROM stat),
tunnels AS (SELECT * FROM scored WHERE score >= 3)"""

CTE["cloud"] = """cloud AS (
  SELECT concat('case-', event_id % 7) AS case_id, event_id AS seq, concat('10.0.0.', user_id % 200 + 1) AS src_ip,
    concat('203.0.', user_id % 6, '.', user_id % 250 + 1) AS dst_ip, 443 AS dst_port,
    CASE user_id % 7 WHEN 0 THEN 'api.telegram.org' WHEN 1 THEN 'Drive.Google.com' WHEN 2 THEN 'cdn.discordapp.com'
      WHEN 3 THEN 'www.dropbox.com' WHEN 4 THEN 'www.example.org' WHEN 5 THEN 'dns.google' ELSE 'mega.nz' END AS host,
    event_type, floor(value * 10)::BIGINT AS orig_bytes, event_id % 997 AS resp_bytes FROM events)"""

CTE["phttp"] = f"""phttp AS (
  SELECT concat('case-', page_id % 7) AS case_id, page_id AS seq, 1704067200.0 + page_id AS ts, concat('10.0.0.', page_id % 200 + 1) AS src_ip,
    concat('203.0.113.', page_id % 40) AS dst_ip,
    CASE page_id % 4 WHEN 0 THEN 80 WHEN 1 THEN 8080 WHEN 2 THEN 55123 ELSE 443 END AS dst_port,
    CASE WHEN page_id % 2 = 0 THEN 'GET' ELSE 'POST' END AS method, {HOST} AS host,
    CASE page_id % 9 WHEN 0 THEN '/Gate.PHP' WHEN 1 THEN '/panel/x' WHEN 2 THEN '/gate'
      ELSE regexp_replace(url, '^[a-z]+://[^/]+', '') END AS uri,
    CASE page_id % 5 WHEN 0 THEN 'curl' WHEN 1 THEN 'Mozilla/5.0' WHEN 2 THEN '' WHEN 3 THEN 'Mozilla/5.0 (X11)' END
      AS user_agent FROM pages)"""

CTE["ptls"] = f"""ptls AS (
  SELECT concat('case-', page_id % 7) AS case_id, page_id AS seq, 1704067200.0 + page_id AS ts, concat('10.0.0.', page_id % 3 + 1) AS src_ip,
    concat('203.0.113.', page_id % 60) AS dst_ip, CASE WHEN page_id % 4 = 0 THEN 4444 ELSE 443 END AS dst_port,
    {HOST} AS server_name, md5({HOST}) AS ja3, md5(concat('s', {HOST})) AS ja3s, concat('CN=', {HOST}) AS subject,
    CASE WHEN page_id % 5 = 0 THEN concat('CN=', {HOST}) ELSE 'CN=Root' END AS issuer,
    CASE page_id % 6 WHEN 1 THEN 'Certificate expired' WHEN 2 THEN 'ok' WHEN 3 THEN '-' END AS validation_status
  FROM pages)"""

CTE["hello"] = """hello AS (
  SELECT concat('case-', l_orderkey % 7) AS case_id, l_orderkey * 8 + l_linenumber AS seq,
    CASE WHEN l_linestatus = 'O' THEN 'client' ELSE 'server' END AS message, concat('203.0.113.', l_suppkey % 250) AS host,
    concat_ws('-', 4865 + l_linenumber, l_partkey % 60000, 49195) AS cipher_text,
    [4865 + l_linenumber, l_partkey % 60000, 49195] AS ciphers, concat_ws('-', 0, 16, l_suppkey % 50, 43) AS ext_text,
    [0, 16, l_suppkey % 50, 43] AS extensions, [1027, l_linenumber] AS sigs,
    l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'h2' ELSE '00' END AS alpn,
    CASE WHEN l_returnflag = 'A' THEN NULL ELSE concat('s', l_suppkey, '.example.com') END AS sni
  FROM lineitem),
printed AS (
  SELECT *, CASE WHEN message = 'client' THEN md5(concat('771,', cipher_text, ',', ext_text, ',29-23,0')) END AS ja3,
    CASE WHEN message = 'server' THEN md5(concat('771,2570,', ext_text)) END AS ja3s,
    CASE WHEN message = 'client' THEN concat('t', CASE WHEN l_linenumber > 3 THEN '13' ELSE '12' END,
      CASE WHEN sni IS NULL THEN 'i' ELSE 'd' END, '0304', alpn, '_',
      substr(sha256(array_to_string(list_sort(list_transform(ciphers, lambda c: printf('%04x', c))), ',')), 1, 12), '_',
      substr(sha256(concat(array_to_string(list_sort(list_transform(list_filter(extensions, lambda e: e NOT IN (0, 16)),
        lambda e: printf('%04x', e))), ','), '_', array_to_string(list_transform(sigs, lambda s: printf('%04x', s)), ','))), 1, 12))
      END AS ja4 FROM hello)"""

CTE["intel"] = f"""intel AS (
  SELECT value, arg_max(source, pr) AS source, arg_max(note, pr) AS note, arg_max(indicator_type, pr) AS indicator_type FROM (
    SELECT {address('c_custkey')} AS value, 'customers' AS source,
      CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'RedLine Stealer C2' WHEN 'BUILDING' THEN 'Emotet C2'
        WHEN 'FURNITURE' THEN 'Cobalt Strike 4.x' WHEN 'HOUSEHOLD' THEN 'generic C2' ELSE 'XLoader panel' END AS note,
      'ip' AS indicator_type, c_custkey AS pr FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT concat('t', s_suppkey % 5, '-update.com'), 'suppliers', 'DNS tunnel domain', 'domain', s_suppkey
      FROM supplier WHERE s_acctbal < 0
    UNION ALL SELECT md5(concat('host', s_suppkey)), 'suppliers', 'Trickbot', 'ja3', s_suppkey FROM supplier
      WHERE s_acctbal < 0) GROUP BY 1)"""

CTE["pkt"] = f"""pkt AS (
  SELECT concat('case-', l_orderkey % 7) AS case_id, (l_orderkey * 8 + l_linenumber) * 100000 + l_partkey % 100000 AS seq,
    epoch(l_shipdate) AS ts, concat('10.0.0.', l_orderkey % 200 + 1) AS client, {address('l_orderkey')} AS server,
    (40000 + l_suppkey % 20000)::INT AS port, l_linestatus = 'O' AS up, l_returnflag AS rf, l_partkey AS part,
    concat('h', l_suppkey % 10, '.example.com') AS host,
    CASE l_returnflag WHEN 'R' THEN concat('POST /gate.php?p=', l_partkey, ' HTTP/1.1', chr(13), chr(10), 'Host: h',
        l_suppkey % 10, '.example.com', chr(13), chr(10), chr(13), chr(10), repeat('x', l_quantity::INT))
      WHEN 'N' THEN concat('STOR part', l_partkey, '.zip', chr(13), chr(10)) ELSE repeat('y', l_quantity::INT) END AS payload
  FROM lineitem)"""

CTE["find"] = f"""find AS (
  SELECT concat('case-', o_orderkey % 7) AS case_id, o_orderkey AS seq,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'beacon' WHEN '2' THEN 'exfil' WHEN '3' THEN 'dns_tunnel'
      WHEN '4' THEN 'http_c2' ELSE 'smtp_exfil' END AS kind, {address('o_custkey')} AS dst_ip, epoch(o_orderdate) AS event_time,
    CASE o_orderkey % 5 WHEN 0 THEN concat('x', o_orderkey % 40, '.t', o_orderkey % 5, '-update.com')
      WHEN 1 THEN 'V10.events.data.microsoft.com' WHEN 2 THEN concat('t', o_orderkey % 5, '-update.com') END AS domain,
    CASE WHEN o_orderstatus = 'P' THEN 'weak' END AS preset, CASE WHEN o_orderpriority LIKE '5%' THEN true ELSE false END AS mailed
  FROM orders),
rep AS (
  SELECT f.*, i.value IS NOT NULL AS ip_hit, i.note AS ip_note, i.source AS ip_source,
    coalesce(d.note, r.note) AS dom_note, coalesce(d.source, r.source) AS dom_source,
    (d.value IS NOT NULL OR r.value IS NOT NULL) AS dom_hit
  FROM find f LEFT JOIN intel i ON i.value = f.dst_ip LEFT JOIN intel d ON d.value = {clean('f.domain')}
    LEFT JOIN intel r ON r.value = {registered(clean('f.domain'))}),
kinds AS (SELECT case_id, dst_ip, count(DISTINCT kind) AS k FROM find GROUP BY 1, 2),
tiered AS (
  SELECT rep.*, (ip_hit OR dom_hit) AS hit,
    CASE WHEN ip_hit THEN ip_note WHEN dom_hit THEN concat('domain intel: ', dom_note) END AS note,
    CASE WHEN ip_hit THEN ip_source WHEN dom_hit THEN dom_source END AS source,
    CASE WHEN ip_hit OR dom_hit THEN 'confirmed' WHEN preset IS NOT NULL THEN preset WHEN k >= 2 THEN 'strong' ELSE 'weak' END
      AS tier
  FROM rep JOIN kinds USING (case_id, dst_ip))"""

CTE["acc"] = """acc AS (
  SELECT concat('case-', event_id % 7) AS case_id, event_id AS seq, epoch(ts) / 60 AS ts,
    round_even(epoch(ts) / 60 * 1e6, 0)::BIGINT AS us, user_id,
    ['browser_credentials', 'keystrokes', 'screenshot', 'clipboard', 'crypto_wallet', 'system_info', 'file_access']
      [user_id % 7 + 1] AS data_type,
    ['T1555.003', 'T1056.001', 'T1113', 'T1115', 'T1005', 'T1082', 'T1005'][user_id % 7 + 1] AS technique,
    CASE WHEN event_type = 'click' THEN 'GetClipboardData' ELSE 'NtReadFile' END AS api_call,
    CASE WHEN user_id % 3 = 0 THEN concat('C:/Users/u', user_id, '/Login Data') WHEN user_id % 2 = 0 THEN 'Login Data' END AS obj
  FROM events WHERE event_type NOT IN ('purchase', 'signup')),
net AS (
  SELECT concat('case-', event_id % 7) AS case_id, event_id AS seq, round_even(epoch(ts) / 60 * 1e6, 0)::BIGINT AS us,
    epoch(ts) / 60 AS ts, user_id, CASE WHEN event_type = 'purchase' THEN 'exfil' ELSE 'http_c2' END AS kind,
    concat('198.51.100.', user_id) AS dst_ip, (443 + user_id % 2)::INT AS dst_port, 0.5 + (user_id % 5) / 10.0 AS conf,
    (event_type = 'signup' AND user_id % 2 = 0) AS rep, event_type = 'signup' AS plain,
    CASE WHEN user_id % 4 = 0 THEN 'events.data.microsoft.com' WHEN user_id % 4 = 1
      THEN concat('drop', user_id, '.example.com') END AS domain,
    CASE WHEN event_type = 'signup' THEN concat('/gate.php?otp=', user_id) END AS uri,
    CASE WHEN user_id % 3 = 0 THEN 'weak' ELSE 'strong' END AS tier
  FROM events WHERE event_type IN ('purchase', 'signup')),
pairs AS (
  SELECT a.case_id, a.seq AS access_seq, n.seq AS network_seq, a.data_type, a.technique, a.api_call, a.obj, a.us AS a_us,
    n.us AS n_us, n.dst_ip, n.dst_port, n.conf, n.rep, concat('t', a.us) AS access_ts,
    (n.us - a.us) / 1e6 AS delta,
    round_even(least((1.0 - ((n.us - a.us) / 1e6 / 15.0) * 0.5) * 0.5 + n.conf * 0.3 + CASE WHEN n.rep THEN 0.2 ELSE 0.0 END, 1.0)
      * 100.0, 0) / 100.0 AS score
  FROM acc a JOIN net n ON a.case_id = n.case_id AND n.us BETWEEN a.us AND a.us + 15000000),
graded AS (
  SELECT *, CASE WHEN rep AND score >= 0.6 THEN 'confirmed' WHEN score >= 0.6 THEN 'strong' WHEN score > 0 THEN 'weak'
    ELSE 'unconfirmed' END AS tier FROM pairs),
best AS (
  SELECT * FROM graded QUALIFY row_number() OVER (PARTITION BY case_id, access_ts, data_type, api_call
    ORDER BY score DESC, n_us, access_seq, network_seq) = 1)"""

CTE["man"] = """man AS (
  SELECT concat('case-', n_nationkey) AS case_id, n_nationkey AS k,
    CASE n_nationkey % 4 WHEN 0 THEN 'simulated' WHEN 1 THEN 'real' WHEN 2 THEN 'unknown' ELSE 'simulated' END AS mode,
    CASE n_nationkey % 4 WHEN 0 THEN 'Simulated-INetSim' WHEN 1 THEN 'live egress' WHEN 2 THEN 'odd' ELSE 'isolated' END AS raw_mode,
    CASE n_nationkey % 3 WHEN 0 THEN true WHEN 1 THEN n_nationkey <= 5 ELSE false END AS clock_ok,
    n_nationkey % 5 <> 0 AS corr_ok, n_nationkey % 2 = 0 AS degraded,
    CASE n_nationkey % 3 WHEN 0 THEN 'Kernel-File' WHEN 1 THEN 'Other' ELSE '' END AS providers,
    CASE n_nationkey % 3 WHEN 0 THEN 'file_access' ELSE '' END AS blind, n_nationkey % 3 <> 0 AS blind_all,
    CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE concat('10.0.0.', n_nationkey + 1) END AS guest,
    n_nationkey % 4 = 1 AS pinned, CASE WHEN n_nationkey % 3 = 2 THEN 'r' END AS reason FROM nation)"""

CTE["ioc"] = f"""ioc AS (
  SELECT concat('case-', c_custkey % 7) AS case_id, c_custkey AS seq, CASE WHEN c_nationkey % 2 = 0 THEN 'RedLine' END AS family,
    CASE c_custkey % 4 WHEN 0 THEN 'ip' WHEN 1 THEN 'domain' WHEN 2 THEN 'url' ELSE 'email' END AS type,
    CASE c_custkey % 4 WHEN 0 THEN {address('c_custkey')} WHEN 1 THEN concat('www.site', c_custkey % 500, '.com')
      WHEN 2 THEN concat('http://', {address('c_custkey')}, ':8080/gate.php')
      ELSE concat('Drop@www.Site', c_custkey % 500, '.com') END AS value, c_mktsegment = 'MACHINERY' AS config,
    CASE c_custkey % 4 WHEN 0 THEN [{address('c_custkey')}] WHEN 1 THEN [concat('www.site', c_custkey % 500, '.com')]
      WHEN 2 THEN [{address('c_custkey')}]
      ELSE [concat('drop@www.site', c_custkey % 500, '.com'), concat('www.site', c_custkey % 500, '.com')] END AS keys
  FROM customer),
seen AS (SELECT case_id, dst_ip AS key FROM conn UNION SELECT case_id, lower(query) FROM dns),
keyed AS (SELECT case_id, seq, unnest(keys) AS key FROM ioc),
hits AS (SELECT case_id, seq, string_agg(key, ',' ORDER BY key) AS matched FROM keyed SEMI JOIN seen USING (case_id, key)
  GROUP BY 1, 2)"""

CTE["site"] = """site AS (SELECT lower(concat('Site', s_suppkey, '.com')) AS domain FROM supplier),
nets AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 2 = 0 THEN concat('203.0.', n_nationkey * 4, '.0/22')
    ELSE concat('203.0.', n_nationkey * 4, '.128/25') END AS cidr,
  CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey * 4 * 256 ELSE n_nationkey * 4 * 256 + 128 END AS lo,
  CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey * 4 * 256 + 1023 ELSE n_nationkey * 4 * 256 + 255 END AS hi FROM nation)"""

CTE["evt"] = f"""evt AS (
  SELECT *, CASE WHEN seq % 6 <> 0 THEN dst_ip END AS ip, sha256(seq::VARCHAR) AS evidence_hash, {technique('kind')} AS technique,
    CASE WHEN tier = 'weak' AND lower(domain) = 'v10.events.data.microsoft.com' THEN 'allowlisted' ELSE tier END AS final
  FROM tiered)"""

CTE["chain"] = """ev AS (
  SELECT concat('user-', user_id) AS case_id, event_id,
    concat(event_id, '|', event_type, '|', floor(value * 100)::BIGINT) AS txt,
    CASE WHEN user_id % 2 = 0 THEN sha256(user_id::VARCHAR) ELSE repeat('0', 64) END AS seed,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos FROM events),
chained AS (
  SELECT case_id, event_id, pos, txt, seed, sha256(concat(seed, txt)) AS h FROM ev WHERE pos = 0
  UNION ALL
  SELECT e.case_id, e.event_id, e.pos, e.txt, e.seed, sha256(concat(c.h, e.txt)) FROM chained c
    JOIN ev e ON e.case_id = c.case_id AND e.pos = c.pos + 1)"""

CTE["label"] = f"""label AS (
  SELECT DISTINCT lower(string_split({registered('query')}, '.')[1]) AS name FROM dns),
marked AS (SELECT name, concat('^', name, '$') AS m FROM label WHERE name <> ''),
grams AS (
  SELECT name, 'ng:' || g AS feature, count(*) / (2.0 * length(name) + 1) AS value FROM (
    SELECT name, unnest(list_concat(list_transform(range(1, length(m)), lambda i: substr(m, i, 2)),
      list_transform(range(1, length(m) - 1), lambda i: substr(m, i, 3)))) AS g FROM marked) GROUP BY 1, 2),
feat AS (
  SELECT * FROM grams
  UNION ALL SELECT name, 'f:len', least(length(name), 30) / 30.0 FROM marked
  UNION ALL SELECT name, 'f:vowel_ratio', length(regexp_replace(name, '[^aeiou]', '', 'g')) / length(name)::DOUBLE FROM marked
  UNION ALL SELECT name, 'f:digit_ratio', length(regexp_replace(name, '[^0-9]', '', 'g')) / length(name)::DOUBLE FROM marked
  UNION ALL SELECT name, 'f:max_consonant_run', least(coalesce(list_max(list_transform(
      regexp_extract_all(name, '[b-df-hj-np-tv-z]+'), lambda r: length(r))), 0), 10) / 10.0 FROM marked
  UNION ALL SELECT name, 'f:entropy', least({ent('name')}, 5.0) / 5.0 FROM marked)"""


def sql(*names: str, body: str, recursive: bool = False) -> str:
    head = "WITH RECURSIVE " if recursive else "WITH "
    ctes = ",\n".join(CTE[n] for n in names)
    return (head + ctes + "\n" if ctes else "") + body


SQL: dict[str, str] = {}

SQL["beaconing"] = sql("conn", body=f""", r AS (
  SELECT *, ts - lag(ts) OVER (PARTITION BY case_id, dst_ip, dst_port ORDER BY ts) AS iv,
    (resp_bytes > 0 OR regexp_matches(history, '[a-z]')) AS answered FROM pub),
s AS (SELECT case_id, dst_ip, dst_port, count(*) AS n, avg(iv) AS m, coalesce(stddev_pop(iv), 0) AS sd,
    avg(orig_bytes) AS mz, stddev_pop(orig_bytes) AS sz, count(*) FILTER (answered) AS a FROM r GROUP BY 1, 2, 3 HAVING count(*) >= 4),
j AS (SELECT *, CASE WHEN m > 0 THEN sd / m ELSE 1.0 END AS jit, CASE WHEN mz > 0 THEN sz / mz ELSE 0.0 END AS cv FROM s),
b AS (SELECT *, jit <= 0.25 AND m >= 1.0 AS beacon FROM j)
SELECT case_id, dst_ip, dst_port, n AS connection_count, {rnd('m', 2)} AS mean_interval_s, {rnd('sd', 3)} AS interval_stddev_s,
  {rnd('jit', 3)} AS jitter_ratio, beacon AS is_beacon,
  {rnd('''CASE WHEN beacon THEN least((1 - jit / 0.25) * 0.55 + least(n / 10.0, 1.0) * 0.35
    + CASE WHEN cv < 0.1 THEN 0.1 ELSE 0.0 END, CASE WHEN a = 0 THEN 0.3 ELSE 1.0 END) ELSE 0.0 END''', 2)} AS confidence,
  {rnd('cv', 3)} AS size_cv, {rnd('a / n::DOUBLE', 2)} AS handshake_ratio, beacon AND a = 0 AS unanswered FROM b""")

_EXFIL = """(http_method IS NOT DISTINCT FROM 'POST' AND orig_bytes >= 1024) AS big,
    (orig_bytes >= CASE WHEN http_method IS NOT DISTINCT FROM 'POST' THEN 1024 ELSE {limit} END AND ratio >= 0.7) AS high"""

SQL["exfil_volume"] = sql("conn", body=f""", f AS (SELECT *, {_EXFIL.format(limit=1024)} FROM pub)
SELECT case_id, seq, src_ip, dst_ip, dst_port, orig_bytes, {rnd('ratio', 2)} AS upload_ratio, http_method, http_uri,
  true AS is_exfil, {rnd("0.5 + CASE WHEN big THEN 0.3 ELSE 0 END + CASE WHEN ratio >= 0.7 THEN 0.2 ELSE 0 END", 2)} AS confidence
FROM f WHERE big OR high""")

_FTP = """ftp AS (SELECT * FROM pub WHERE ftp_upload_cmd IS NOT NULL QUALIFY row_number() OVER (PARTITION BY case_id, dst_ip
  ORDER BY seq, src_ip, dst_port, orig_bytes, resp_bytes, ftp_upload_cmd) = 1)"""

SQL["ftp_store_exfil"] = sql("conn", body=f""", {_FTP}
SELECT case_id, seq, src_ip, dst_ip, dst_port, orig_bytes, {rnd('ratio', 2)} AS upload_ratio, 'FTP' AS http_method,
  ftp_upload_cmd AS http_uri, true AS is_exfil, 0.8 AS confidence FROM ftp""")

SQL["exfil_merged"] = sql("conn", body=f""", f AS (SELECT *, {_EXFIL.format(limit=40000)} FROM pub),
vol AS (SELECT * FROM f WHERE big OR high), {_FTP},
m AS (SELECT case_id, seq, dst_ip, dst_port, orig_bytes, http_method, http_uri,
    {rnd("0.5 + CASE WHEN big THEN 0.3 ELSE 0 END + CASE WHEN ratio >= 0.7 THEN 0.2 ELSE 0 END", 2)} AS confidence FROM vol UNION ALL
  SELECT case_id, seq, dst_ip, dst_port, orig_bytes, 'FTP', ftp_upload_cmd, 0.8 FROM ftp ANTI JOIN vol USING (case_id, dst_ip, dst_port))
SELECT * FROM m""")

SQL["unclassified_egress"] = sql("conn", body=f""", {_FTP},
e AS (SELECT * FROM pub ANTI JOIN ftp USING (case_id, dst_ip) WHERE orig_bytes >= 2048 AND ratio >= 0.6
  QUALIFY row_number() OVER (PARTITION BY case_id, dst_ip, dst_port ORDER BY seq, orig_bytes, ratio) = 1)
SELECT case_id, dst_ip, dst_port, seq, orig_bytes, {rnd('ratio', 2)} AS upload_ratio FROM e""")

SQL["to_connections"] = sql("sess", "ohttp", "oftp", body=""",
up AS (SELECT *, trim(concat(command, ' ', arg)) AS stored FROM oftp WHERE upper(command) IN ('STOR', 'STOU', 'APPE')),
hu AS (SELECT * FROM ohttp WHERE uid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY case_id, uid ORDER BY seq) = 1),
hk AS (SELECT * FROM ohttp QUALIFY row_number() OVER (PARTITION BY case_id, src_ip, dst_ip, dst_port ORDER BY seq) = 1),
fu AS (SELECT * FROM up WHERE uid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY case_id, uid ORDER BY seq) = 1),
fk AS (SELECT * FROM up QUALIFY row_number() OVER (PARTITION BY case_id, src_ip, dst_ip ORDER BY seq) = 1)
SELECT s.case_id, s.seq, s.dst_ip, s.orig_bytes, CASE WHEN hu.seq IS NOT NULL THEN hu.method ELSE hk.method END AS http_method,
  CASE WHEN hu.seq IS NOT NULL THEN hu.host ELSE hk.host END AS http_host,
  CASE WHEN hu.seq IS NOT NULL THEN hu.uri ELSE hk.uri END AS http_uri, coalesce(fu.stored, fk.stored) AS ftp_upload_cmd
FROM sess s LEFT JOIN hu ON hu.case_id = s.case_id AND hu.uid = s.uid
  LEFT JOIN hk ON hk.case_id = s.case_id AND hk.src_ip = s.src_ip AND hk.dst_ip = s.dst_ip AND hk.dst_port = s.dst_port
  LEFT JOIN fu ON fu.case_id = s.case_id AND fu.uid = s.uid
  LEFT JOIN fk ON fk.case_id = s.case_id AND fk.src_ip = s.src_ip AND fk.dst_ip = s.dst_ip""")

SQL["record_counts"] = sql("sess", "ohttp", "dns", body="""
SELECT case_id, 'sessions' AS table_name, count(*) AS records FROM sess GROUP BY 1 UNION ALL
SELECT case_id, 'http', count(*) FROM ohttp GROUP BY 1 UNION ALL SELECT case_id, 'dns', count(*) FROM dns GROUP BY 1""")

SQL["ip_classes"] = """WITH r AS (SELECT DISTINCT c_custkey % 8 AS k, c_custkey % 40 AS b, c_custkey % 300 AS h, c_nationkey AS n,
  CASE c_custkey % 8 WHEN 0 THEN concat('10.', c_custkey % 256, '.0.', c_nationkey)
  WHEN 1 THEN concat('172.', c_custkey % 40, '.1.', c_nationkey) WHEN 2 THEN concat('203.0.113.', c_custkey % 300)
  WHEN 3 THEN concat('fe80::', c_nationkey) WHEN 4 THEN concat('2001:db8::', c_nationkey, ':1')
  WHEN 5 THEN concat('224.0.0.', c_nationkey) WHEN 6 THEN concat('host', c_custkey, '.example.com')
  ELSE concat('198.18.', c_nationkey, '.255') END AS ip FROM customer),
c AS (SELECT ip, k, b, n, CASE k WHEN 2 THEN h < 256 WHEN 6 THEN false ELSE true END AS lit,
    h FROM r)
SELECT DISTINCT ip, lit AS is_literal, CASE k WHEN 0 THEN true WHEN 1 THEN b BETWEEN 16 AND 31 WHEN 3 THEN true ELSE false END AS is_private,
  CASE k WHEN 0 THEN true WHEN 1 THEN b BETWEEN 16 AND 31 WHEN 2 THEN lit WHEN 3 THEN true WHEN 4 THEN true WHEN 7 THEN true
    ELSE false END AS is_special,
  CASE k WHEN 0 THEN n = 0 WHEN 1 THEN n = 0 WHEN 2 THEN lit AND (h = 255 OR h = 0) WHEN 3 THEN true
    WHEN 5 THEN true WHEN 7 THEN true ELSE false END AS is_noise FROM c"""

SQL["host_domains"] = sql("conn", body="""
SELECT case_id, seq, string_split(lower(http_host), ':')[1] AS domain FROM conn WHERE http_host IS NOT NULL""")

_GUEST = """guest AS (SELECT case_id, src_ip AS guest_ip, n AS sessions FROM (SELECT case_id, src_ip, count(*) AS n, min(seq) AS f FROM {t} GROUP BY 1, 2)
  QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY n DESC, f) = 1)"""

SQL["infer_guest"] = sql("conn", body=f""", {_GUEST.format(t='conn')} SELECT * FROM guest""")

SQL["case_scope"] = sql("sess", "ohttp", "man", body=f""", {_GUEST.format(t='sess')},
rule AS (SELECT m.case_id, coalesce(m.guest, g.guest_ip) AS g FROM man m LEFT JOIN guest g USING (case_id)),
rows AS (SELECT case_id, 'sessions' AS table_name, src_ip, dst_ip, ts FROM sess UNION ALL
  SELECT case_id, 'http', src_ip, dst_ip, ts FROM ohttp),
k AS (SELECT rows.*, (src_ip = g OR dst_ip = g) AND ts >= 788918400 AND ts <= 915148800 AS keep FROM rows JOIN rule USING (case_id))
SELECT case_id, table_name, count(*) FILTER (keep) AS kept, count(*) FILTER (NOT keep) AS removed FROM k GROUP BY 1, 2""")

SQL["simulated_scope"] = sql("sess", "dns", body=f""", {_GUEST.format(t='sess')}
SELECT DISTINCT s.case_id, s.dst_ip FROM sess s JOIN guest g ON g.case_id = s.case_id AND g.guest_ip = s.src_ip
WHERE {private('s.dst_ip')} AND s.dst_ip NOT LIKE '%.0' AND s.dst_ip NOT LIKE '%.255'
  AND NOT EXISTS (SELECT 1 FROM dns d WHERE d.case_id = s.case_id AND d.dst_ip = s.dst_ip)""")

SQL["dns_tunnel"] = sql("dns", "tunnel", body=f""",
rc AS (SELECT case_id, domain, dst_ip, count(*) AS c, min(seq) AS f FROM q GROUP BY 1, 2, 3),
rr AS (SELECT *, row_number() OVER (PARTITION BY case_id, domain ORDER BY c DESC, f) AS rk FROM rc),
res AS (SELECT case_id, domain, string_agg(dst_ip, ',' ORDER BY rk) AS resolvers FROM rr WHERE rk <= 3 GROUP BY 1, 2)
SELECT case_id, domain, n AS query_count, {rnd('e', 2)} AS avg_entropy, {rnd('l', 1)} AS avg_sub_len,
  {rnd('rt', 2)} AS tunnel_rt_fraction, {rnd('u', 2)} AS unique_ratio, {rnd('nx', 2)} AS nxdomain_ratio,
  {rnd('least(1.0, 0.5 + 0.15 * score)', 2)} AS confidence, resolvers FROM tunnels JOIN res USING (case_id, domain)""")

SQL["dga_burst"] = f"""WITH q AS (SELECT concat('case-', event_id % 7) AS case_id, event_type NOT IN ('click', 'signup') AS nx,
    CASE WHEN event_type IN ('click', 'signup') THEN concat('site', user_id, '.com') ELSE concat(md5(event_id::VARCHAR), '.com') END AS domain FROM events),
d AS (SELECT case_id, domain, count(*) AS n, count(*) FILTER (nx) AS nx FROM q GROUP BY 1, 2),
c AS (SELECT case_id, count(*) FILTER (nx > 0) AS k, sum(n) AS total, sum(nx) / sum(n)::DOUBLE AS share,
  avg({ent("string_split(domain, '.')[1]")}) FILTER (nx > 0) AS e FROM d GROUP BY 1)
SELECT case_id, 'dga' AS kind, concat('<', k, ' algorithmic domains>') AS domain, total::BIGINT AS query_count,
  {rnd('e', 2)} AS avg_entropy, 0.0 AS avg_sub_len, 0.0 AS tunnel_rt_fraction, 1.0 AS unique_ratio, {rnd('share', 2)} AS nxdomain_ratio,
  0.7 AS confidence FROM c WHERE k >= 10 AND e >= 3.2 AND share >= 0.5"""

SQL["doh_endpoints"] = sql("cloud", body=f"""
SELECT DISTINCT case_id, lower(host) AS domain FROM cloud WHERE lower(host) IN ({_list(vocab.DOH_HOSTS)})""")

SQL["resolved_destinations"] = sql("dns", "tunnel", body=f""",
nm AS (SELECT case_id, {clean('query')} AS domain, count(*) AS query_count FROM dns WHERE contains({clean('query')}, '.') GROUP BY 1, 2),
own AS (SELECT case_id, lower(domain) AS parent FROM tunnels),
par AS (SELECT case_id, domain, unnest({suffixes('domain', 2)}) AS parent FROM nm),
keep AS (SELECT * FROM nm ANTI JOIN (SELECT case_id, domain FROM par SEMI JOIN own USING (case_id, parent)) USING (case_id, domain)),
bg AS (SELECT *, NOT list_has_any({suffixes('domain')}, [{_list(vocab.ABUSED_HOSTS)}]) AND
  list_has_any({suffixes('domain')}, [{_list(vocab.OS_BACKGROUND)}]) AS back, {subdomain('domain')} AS sub FROM keep)
SELECT case_id, domain, query_count, round(CASE WHEN sub <> '' THEN {ent('sub')} ELSE {ent('domain')} END, 6) AS avg_entropy,
  length(sub)::DOUBLE AS avg_sub_len, CASE WHEN back THEN 0.0 ELSE 0.4 END AS confidence,
  concat(domain, ' was asked for ', query_count, ' time(s). ', CASE WHEN back
    THEN 'Known background traffic of the operating system or a vendor.'
    ELSE 'Not known as background traffic: the sample meant to reach this name.' END)
    AS evidence FROM bg""")

SQL["name_features"] = sql("dns", body=f""", n AS (SELECT DISTINCT lower(query) AS q FROM dns)
SELECT q, {registered('q')} AS registered, {subdomain('q')} AS sub, round({ent('q')}, 6) AS entropy FROM n""")

_SERVICE = "CASE " + " ".join(
    f"WHEN h = '{d}' OR ends_with(h, '.{d}') THEN {i}" for i, (d, _, _) in enumerate(vocab.CLOUD_SERVICES, start=1)
) + " END"

SQL["cloud_exfil"] = sql("cloud", body=f""",
ep AS (SELECT *, {clean('host')} AS h, CASE WHEN event_type IN ('click', 'signup') THEN 0 ELSE 1 END AS src FROM cloud),
m AS (SELECT *, {_SERVICE} AS no FROM ep),
f AS (SELECT * FROM m WHERE no IS NOT NULL QUALIFY row_number() OVER (PARTITION BY case_id, dst_ip, host ORDER BY src, seq) = 1),
s AS (SELECT * FROM cloud QUALIFY row_number() OVER (PARTITION BY case_id, src_ip, dst_ip, dst_port ORDER BY seq DESC) = 1)
SELECT f.case_id, [{_list(n for _, n, _ in vocab.CLOUD_SERVICES)}][no] AS service,
  [{_list(r for _, _, r in vocab.CLOUD_SERVICES)}][no] AS risk, f.host AS domain, f.dst_ip, f.dst_port,
  CASE WHEN s.orig_bytes > s.resp_bytes * 1.2 AND s.orig_bytes > 0 THEN 'upload' WHEN s.resp_bytes > s.orig_bytes THEN 'download'
    ELSE 'unknown' END AS direction,
  CASE WHEN NOT (s.orig_bytes > s.resp_bytes * 1.2 AND s.orig_bytes > 0) AND s.resp_bytes > s.orig_bytes THEN 'cloud_staging'
    ELSE 'cloud_exfil' END AS category,
  CASE [{_list(r for _, _, r in vocab.CLOUD_SERVICES)}][no] WHEN 'high' THEN 0.75 ELSE 0.4 END AS confidence
FROM f JOIN s USING (case_id, src_ip, dst_ip, dst_port)""")

SQL["smtp_exfil"] = f"""WITH m AS (
  SELECT concat('case-', conv_id % 7) AS case_id, conv_id * 1000 + turn AS seq, concat('198.51.100.', conv_id % 50) AS dst_ip,
    CASE WHEN role <> 'user' THEN concat('bot', conv_id % 5, '@service.example')
      WHEN conv_id % 8 <> 0 THEN concat('U', conv_id % 9, '@Example.com') END AS mail_from,
    conv_id % 16 = 0 AS empty, concat('u', turn % 9, '@example.com') AS r1, concat('c', conv_id, '@drop.example') AS r2,
    concat('conversation ', conv_id, ' turn ', turn) AS subject, length(text) % 3 = 0 AS att FROM conversations),
g AS (SELECT *, coalesce(NOT empty AND lower(mail_from) IN (r1, r2), false) AS self FROM m)
SELECT case_id, seq, dst_ip, mail_from, CASE WHEN empty THEN '' ELSE concat(r1, ',', r2) END AS rcpt_to, subject,
  att AS has_attachment, self AS self_send,
  {rnd('0.6 + CASE WHEN att THEN 0.15 ELSE 0 END + CASE WHEN self THEN 0.15 ELSE 0 END', 2)} AS confidence
FROM g WHERE mail_from IS NOT NULL OR NOT empty"""

_GATE = "(?i)" + "|".join(vocab.GATE_PATTERNS)

SQL["http_gate"] = sql("phttp", body=f""",
h AS (SELECT *, regexp_matches(uri, '{_GATE}') AS gate,
  coalesce(lower(trim(user_agent)) IN ({_list(vocab.SUSPICIOUS_AGENTS)}), false) AS ua FROM phttp)
SELECT case_id, dst_ip, seq, dst_port, host, uri, method,
  concat_ws('; ', CASE WHEN gate THEN concat('C2 gate pattern in URI (', substr(uri, 1, 48), ')') END,
    CASE WHEN ua THEN concat('suspicious/hardcoded user-agent (''', user_agent, ''')') END) AS reason,
  CASE WHEN gate THEN 'strong' ELSE 'weak' END AS severity, CASE WHEN gate THEN 0.7 ELSE 0.45 END AS confidence
FROM h WHERE gate OR ua QUALIFY row_number() OVER (PARTITION BY case_id, dst_ip, uri ORDER BY seq) = 1""")

SQL["icmp_tunnel"] = """WITH s AS (SELECT concat('case-', event_id % 2) AS case_id,
  concat(CASE WHEN event_type = 'error' THEN '198.51.' ELSE '198.52.' END, user_id // 250, '.', user_id % 250) AS dst_ip, count(*) AS n,
  avg(CASE WHEN event_type = 'error' THEN floor(value)::INT ELSE 56 END) AS m, min(event_id) AS seq FROM events GROUP BY 1, 2)
SELECT case_id, seq, 'icmp_tunnel' AS kind, dst_ip, 0 AS dst_port,
  concat(n, ' ICMP echoes, avg payload ', round_even(m, 0)::BIGINT, 'B (normal ping ~32-48B)') AS detail,
  0.75 AS confidence, 'strong' AS severity FROM s WHERE n >= 8 AND m >= 64"""

SQL["port_mismatch"] = sql("phttp", "ptls", body=f""",
o AS (SELECT case_id, dst_ip, dst_port, 0 AS src FROM phttp WHERE dst_port NOT IN ({', '.join(map(str, vocab.HTTP_PORTS))})
  UNION ALL SELECT case_id, dst_ip, dst_port, 1 FROM ptls WHERE dst_port NOT IN ({', '.join(map(str, vocab.TLS_PORTS))}))
SELECT case_id, 'port_mismatch' AS kind, dst_ip, dst_port,
  concat(CASE WHEN min(src) = 0 THEN 'HTTP' ELSE 'TLS' END, ' on non-standard port ', dst_port) AS detail, 0.4 AS confidence,
  'weak' AS severity FROM o GROUP BY case_id, dst_ip, dst_port""")

SQL["ja3_hash"] = sql("hello", body="""
SELECT case_id, message, ja3, ja3s, count(*) AS hellos FROM printed GROUP BY 1, 2, 3, 4""")
SQL["ja4_hash"] = sql("hello", body="""
SELECT case_id, ja4, count(*) AS hellos FROM printed WHERE message = 'client' GROUP BY 1, 2""")
SQL["hello_pairs"] = sql("hello", body="""
SELECT coalesce(c.case_id, s.case_id) AS case_id, '10.0.0.1' AS src_ip, coalesce(c.host, s.host) AS dst_ip, 443 AS dst_port,
  c.ja3, s.ja3s, c.sni AS server_name
FROM (SELECT * FROM printed WHERE message = 'client' QUALIFY row_number() OVER (PARTITION BY case_id, host
    ORDER BY seq DESC, ja3 DESC, sni DESC NULLS LAST) = 1) c
FULL JOIN (SELECT * FROM printed WHERE message = 'server' QUALIFY row_number() OVER (PARTITION BY case_id, host
    ORDER BY seq DESC, ja3s DESC) = 1) s ON c.case_id = s.case_id AND c.host = s.host""")
SQL["first_client_hello"] = sql("hello", body="""
SELECT case_id, '10.0.0.1' AS src_ip, host AS dst_ip, 443 AS dst_port, seq, server_name, ja3, ja4 FROM (
  SELECT p.*, p.sni AS server_name, l.ts FROM printed p JOIN (SELECT l_orderkey * 8 + l_linenumber AS s2,
    l_partkey % 60000 AS pk, l_suppkey AS sk, min(epoch(l_shipdate)) AS ts FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2, 3) l
    ON l.s2 = p.seq AND p.ciphers[2] = l.pk AND (p.sni IS NULL OR p.sni = concat('s', l.sk, '.example.com'))
    AND p.host = concat('203.0.113.', l.sk % 250) WHERE message = 'client')
QUALIFY row_number() OVER (PARTITION BY case_id, host ORDER BY seq, ts, server_name NULLS FIRST, ja3, ja4) = 1""")

SQL["tls_certificate"] = sql("ptls", body="""
SELECT case_id, seq, dst_ip, dst_port, server_name, CASE WHEN subject = issuer THEN 'self-signed certificate'
  ELSE concat('certificate validation failed: ', lower(validation_status)) END AS reason,
  CASE WHEN subject = issuer THEN 'strong' ELSE 'weak' END AS severity
FROM ptls WHERE subject = issuer OR lower(coalesce(validation_status, '')) NOT IN ('', 'ok', '-')""")
SQL["ja3_records"] = sql("ptls", body="""
SELECT case_id, src_ip, dst_ip, dst_port, ja3, ja3s, server_name, subject FROM ptls
QUALIFY row_number() OVER (PARTITION BY case_id, src_ip, dst_ip, dst_port ORDER BY seq DESC) = 1""")
SQL["service_fingerprint"] = sql("ptls", body=""",
k AS (SELECT case_id, src_ip, dst_ip, dst_port, min(seq) AS f, arg_max(ja3, seq) AS ja3, arg_max(server_name, seq) AS server_name
  FROM ptls GROUP BY 1, 2, 3, 4)
SELECT case_id, dst_ip, dst_port, ja3, server_name FROM k
QUALIFY row_number() OVER (PARTITION BY case_id, dst_ip, dst_port ORDER BY f) = 1""")
SQL["tls_reputation"] = sql("ptls", body=f""",
bad AS (SELECT DISTINCT md5({HOST}) AS value, 'ja3' AS k FROM pages WHERE page_id % 10 = 3
  UNION SELECT concat('203.0.113.', s_suppkey % 60), 'ip' FROM supplier WHERE s_acctbal < 0),
cov AS (SELECT 'case-1' AS case_id, concat('203.0.113.', s_suppkey % 60) AS dst_ip FROM supplier WHERE s_nationkey = 7),
p AS (SELECT ptls.*, i.value IS NOT NULL AS ip_hit, j.value IS NOT NULL AS ja_hit FROM ptls ANTI JOIN cov USING (case_id, dst_ip)
  LEFT JOIN bad i ON i.value = ptls.dst_ip LEFT JOIN bad j ON j.value = ptls.ja3),
fh AS (SELECT * FROM p WHERE ip_hit OR ja_hit QUALIFY row_number() OVER (PARTITION BY case_id, dst_ip ORDER BY seq) = 1)
SELECT case_id, seq, 'ja3' AS kind, dst_ip, dst_port, server_name, 0.7 AS confidence, true AS reputation_hit,
  NULL::VARCHAR AS severity, CASE WHEN ip_hit THEN 'ip' ELSE 'ja3' END AS match_on FROM fh
UNION ALL
SELECT p.case_id, p.seq, 'tls_cert', p.dst_ip, p.dst_port, p.server_name, 0.6, false,
  CASE WHEN p.subject = p.issuer THEN 'strong' ELSE 'weak' END, NULL FROM p LEFT JOIN fh ON fh.case_id = p.case_id AND fh.dst_ip = p.dst_ip
WHERE (p.subject = p.issuer OR lower(coalesce(p.validation_status, '')) NOT IN ('', 'ok', '-')) AND (fh.seq IS NULL OR p.seq < fh.seq)""")
SQL["known_bad_ja3"] = "SELECT ja3, description, count(*) AS n FROM (SELECT [" + _list(v for v, _ in vocab.KNOWN_BAD_JA3) + \
    "][page_id % 4 + 1] AS ja3, [" + _list(d for _, d in vocab.KNOWN_BAD_JA3) + \
    "][page_id % 4 + 1] AS description FROM pages WHERE page_id % 3 = 0) GROUP BY 1, 2"

SQL["flow_assembly"] = sql("pkt", body=""",
o AS (SELECT *, first_value(up) OVER (PARTITION BY case_id, client, server, port ORDER BY seq, ts, up) AS first_up,
  (server LIKE '192.168.%') AS inside FROM pkt),
f AS (SELECT *, CASE WHEN NOT inside THEN up ELSE up = first_up END AS fwd,
  CASE WHEN inside AND NOT first_up THEN false ELSE true END AS normal FROM o)
SELECT case_id, min(seq) AS seq, arg_min(ts, (seq, ts)) AS ts, CASE WHEN normal THEN client ELSE server END AS src_ip,
  CASE WHEN normal THEN port ELSE 443 END AS src_port, CASE WHEN normal THEN server ELSE client END AS dst_ip,
  CASE WHEN normal THEN 443 ELSE port END AS dst_port, coalesce(sum(length(payload)) FILTER (fwd), 0)::BIGINT AS orig_bytes,
  coalesce(sum(length(payload)) FILTER (NOT fwd), 0)::BIGINT AS resp_bytes,
  max(CASE WHEN fwd AND rf = 'R' THEN 'POST' END) AS http_method,
  arg_max(host, (seq, host)) FILTER (fwd AND rf = 'R') AS http_host,
  arg_max(concat('/gate.php?p=', part), (seq, concat('/gate.php?p=', part))) FILTER (fwd AND rf = 'R') AS http_uri,
  arg_min(concat('STOR part', part, '.zip'), (seq, concat('STOR part', part, '.zip'))) FILTER (fwd AND rf = 'N') AS ftp_upload_cmd
FROM f GROUP BY case_id, client, server, port, normal""")

SQL["smtp_envelopes"] = """WITH m AS (SELECT concat('case-', conv_id % 7) AS case_id, conv_id * 1000 + turn AS seq,
  concat('198.51.100.', conv_id % 200) AS dst_ip, CASE WHEN conv_id % 2 = 0 THEN 25 ELSE 587 END AS dst_port,
  concat(role, turn, '@a.example') AS f, concat('r', turn % 3, '@b.example') AS r, concat('t', turn) AS s,
  (length(text) % 2 = 0)::INT AS att FROM conversations),
r AS (SELECT case_id, dst_ip, dst_port, r, min(seq) AS p FROM m GROUP BY 1, 2, 3, 4),
l AS (SELECT case_id, dst_ip, dst_port, string_agg(r, ',' ORDER BY p) AS rcpt_to FROM r GROUP BY 1, 2, 3)
SELECT case_id, min(seq) AS seq, '10.0.0.5' AS src_ip, dst_ip, dst_port, arg_max(f, seq) AS mail_from, any_value(rcpt_to) AS rcpt_to,
  arg_max(s, seq) AS subject, sum(att)::INT AS attachments FROM m JOIN l USING (case_id, dst_ip, dst_port) GROUP BY 1, 4, 5"""

SQL["smtp_items"] = """WITH m AS (SELECT concat('case-', conv_id % 7) AS case_id, conv_id * 1000 + turn AS seq,
  concat('198.51.100.', conv_id % 200) AS dst_ip, CASE WHEN conv_id % 2 = 0 THEN 25 ELSE 587 END AS dst_port,
  concat('r', turn % 3, '@b.example') AS r, length(text) % 2 = 0 AS att FROM conversations),
i AS (SELECT case_id, dst_ip, dst_port, 'recipient' AS kind, min(seq) AS seq, r AS value FROM m GROUP BY 1, 2, 3, 6
  UNION ALL SELECT case_id, dst_ip, dst_port, 'attachment', seq, 'attachment' FROM m WHERE att)
SELECT case_id, '10.0.0.5' AS src_ip, dst_ip, dst_port, kind,
  row_number() OVER (PARTITION BY case_id, dst_ip, dst_port, kind ORDER BY seq)::INT AS position, value FROM i"""

_CONTENT = """up AS (SELECT case_id, seq, ts, client AS source_ip, server AS dest_ip, 443 AS dport, payload FROM pkt
  WHERE up AND server NOT LIKE '192.168.%'),
agg AS (SELECT case_id, source_ip, dest_ip, min(seq) AS seq, sum(length(payload))::BIGINT AS total_bytes,
  string_agg(payload, '' ORDER BY seq, ts, payload) AS content FROM up GROUP BY 1, 2, 3 HAVING sum(length(payload)) >= 64)"""

SQL["outbound_content"] = sql("pkt", body=f""", {_CONTENT}
SELECT case_id, seq, source_ip, dest_ip, total_bytes, sha256(content) AS sha256, sha256(substr(content, 1, 100)) AS head_sha256,
  regexp_replace(substr(content, 1, 300), '[^ -~]', '.', 'g') AS preview FROM agg""")
SQL["outbound_artifacts"] = sql("pkt", body=f""", {_CONTENT},
files AS (SELECT concat('case-', o_orderkey % 3) AS case_id, o_orderkey AS seq, floor(o_totalprice)::BIGINT AS total_bytes,
  sha256(o_orderkey::VARCHAR) AS sha256, NULL::VARCHAR AS head_sha256,
  CASE WHEN o_orderstatus = 'O' THEN '10.0.0.9' ELSE '203.0.113.9' END AS source_ip, {address('o_custkey')} AS dest_ip,
  true AS is_outbound, NULL::VARCHAR AS preview FROM orders
  WHERE (o_orderstatus = 'P' AND o_custkey % 9 = 0) OR (o_orderstatus = 'O' AND o_custkey % 11 <> 0))
SELECT * FROM files UNION ALL
SELECT case_id, seq, total_bytes, sha256(content), sha256(content), source_ip, dest_ip, true,
  regexp_replace(substr(content, 1, 300), '[^ -~]', '.', 'g') FROM agg WHERE case_id NOT IN (SELECT case_id FROM files)""")

SQL["intel_lookup"] = sql("conn", "intel", body="""
SELECT c.case_id, c.seq, (i.value IS NOT NULL OR j.value IS NOT NULL) AS reputation_hit,
  CASE WHEN i.value IS NOT NULL THEN i.source ELSE j.source END AS reputation_source,
  CASE WHEN i.value IS NOT NULL THEN i.note WHEN j.value IS NOT NULL THEN concat('JA3 match: ', j.note) END AS reputation_note,
  CASE WHEN i.value IS NOT NULL THEN 'ip' WHEN j.value IS NOT NULL THEN 'ja3' END AS match_on
FROM conn c LEFT JOIN intel i ON i.value = c.dst_ip LEFT JOIN intel j ON j.value = md5(concat('host', c.seq % 300))""")
SQL["domain_reputation"] = sql("dns", "intel", body=f""", n AS (SELECT DISTINCT case_id, query AS destination_domain FROM dns)
SELECT n.*, (d.value IS NOT NULL OR r.value IS NOT NULL) AS domain_hit, CASE WHEN d.value IS NOT NULL THEN d.source ELSE r.source END
  AS domain_source, CASE WHEN d.value IS NOT NULL THEN d.note ELSE r.note END AS domain_note
FROM n LEFT JOIN intel d ON d.value = {clean('destination_domain')} LEFT JOIN intel r ON r.value = {registered(clean('destination_domain'))}""")


def _allow(domain: str, ip: str) -> str:
    fixed = f"list_filter({suffixes(clean(domain))}, lambda s: list_contains([{_list(vocab.ALLOWLIST_DOMAINS)}], s))[1]"
    return f"{fixed}"


SQL["suffix_allowlist"] = sql("dns", "conn", "site", body=f""",
n AS (SELECT DISTINCT query AS d, dst_ip FROM dns UNION SELECT DISTINCT NULL, dst_ip FROM conn),
sx AS (SELECT DISTINCT d, unnest({suffixes(clean('d'))}) AS p FROM n WHERE d IS NOT NULL),
sm AS (SELECT d, arg_max(p, length(p)) AS site FROM sx JOIN site ON site.domain = p GROUP BY 1),
num AS (SELECT DISTINCT dst_ip, string_split(dst_ip, '.')[3]::INT * 256 + string_split(dst_ip, '.')[4]::INT AS v FROM n
  WHERE dst_ip LIKE '203.0.%'),
nm AS (SELECT dst_ip, cidr FROM num JOIN nets ON v BETWEEN lo AND hi),
m AS (SELECT n.*, {_allow('n.d', '')} AS fixed, sm.site, nm.cidr FROM n LEFT JOIN sm ON sm.d = n.d LEFT JOIN nm USING (dst_ip))
SELECT d AS destination_domain, dst_ip, coalesce(CASE WHEN length(site) > coalesce(length(fixed), 0) THEN site END, fixed, cidr)
  AS allowlist_match FROM m""")

SQL["geo_range"] = sql("conn", body=""",
i AS (SELECT DISTINCT case_id, dst_ip, string_split(dst_ip, '.')[1]::BIGINT * 16777216 + string_split(dst_ip, '.')[2]::BIGINT * 65536
  + string_split(dst_ip, '.')[3]::BIGINT * 256 + string_split(dst_ip, '.')[4]::BIGINT AS v FROM conn),
j AS (SELECT DISTINCT concat('case-', l_orderkey % 7) AS case_id,
  concat('2001:db8:', printf('%x', l_suppkey % 400), '::', printf('%x', l_orderkey % 9000)) AS dst_ip,
  (l_suppkey % 400) * 4294967296 + l_orderkey % 9000 AS v FROM lineitem),
g AS (
  SELECT case_id, dst_ip, n_name, n_nationkey, n_regionkey
  FROM i LEFT JOIN nation ON v BETWEEN 3405774848 + n_nationkey * 1000 AND 3405774848 + n_nationkey * 1000 + 799
  UNION ALL SELECT case_id, dst_ip, n_name, n_nationkey, n_regionkey
  FROM j LEFT JOIN nation ON v BETWEEN n_nationkey * 16 * 4294967296 + 4096 AND (n_nationkey * 16 + 11) * 4294967296 + 8191)
SELECT case_id, dst_ip, n_name AS geo_country, CASE WHEN n_name IS NOT NULL THEN concat('AS', n_nationkey) END AS asn,
  CASE WHEN n_name IS NOT NULL THEN concat('Org ', n_regionkey) END AS asn_org FROM g""")
SQL["geo_network"] = sql("conn", body=""",
i AS (SELECT DISTINCT case_id, dst_ip, CASE WHEN dst_ip LIKE '203.0.%' THEN string_split(dst_ip, '.')[3]::INT END AS b FROM conn),
w AS (SELECT n_nationkey * 2 - n_nationkey * 2 % 8 AS b0, min(n_name) AS c, min(concat('AS', n_nationkey)) AS a,
  min(concat('Org ', n_regionkey)) AS o FROM nation WHERE n_nationkey % 3 <> 0 GROUP BY 1),
s AS (SELECT n_nationkey * 2 AS b0, n_name AS c, concat('AS', n_nationkey) AS a, concat('Org ', n_regionkey) AS o FROM nation
  WHERE n_nationkey % 3 = 0)
SELECT case_id, dst_ip, coalesce(s.c, w.c) AS geo_country, coalesce(s.a, w.a) AS asn, coalesce(s.o, w.o) AS asn_org
FROM i LEFT JOIN s ON b BETWEEN s.b0 AND s.b0 + 1 LEFT JOIN w ON b BETWEEN w.b0 AND w.b0 + 7""")

SQL["corroboration_tier"] = sql("intel", "find", body="""
SELECT case_id, seq, kind, dst_ip, hit AS reputation_hit, note AS reputation_note, source AS reputation_source,
  CASE WHEN NOT ip_hit AND preset IS NOT NULL THEN 'note' END AS beacon_note, tier AS confidence_tier FROM tiered""")
SQL["allowlist_tier"] = sql("intel", "find", "site", body=f""",
num AS (SELECT DISTINCT dst_ip, string_split(dst_ip, '.')[3]::INT * 256 + string_split(dst_ip, '.')[4]::INT AS v FROM tiered
  WHERE dst_ip LIKE '203.0.%'),
nm AS (SELECT dst_ip, cidr FROM num JOIN nets ON v BETWEEN lo AND hi),
m AS (SELECT t.*, coalesce({_allow('t.domain', '')}, nm.cidr) AS mt FROM tiered t LEFT JOIN nm USING (dst_ip))
SELECT case_id, seq, CASE WHEN tier = 'weak' AND mt IS NOT NULL THEN 'allowlisted' ELSE tier END AS confidence_tier,
  CASE WHEN tier = 'weak' THEN mt END AS allowlist_match FROM m""")

_CAPPED = """b AS (SELECT best.*, m.clock_ok, (NOT best.rep AND best.tier IN ('strong', 'confirmed') AND (NOT m.clock_ok
    OR (m.degraded AND (m.blind_all OR best.data_type = m.blind)))) AS cap FROM best JOIN man m USING (case_id) WHERE m.corr_ok)"""
_ALIGNED = """t AS (SELECT concat('case-', event_id % 7) AS case_id, event_type NOT IN ('purchase', 'signup') AS host,
  round_even(epoch(ts) / 60 * 60 * 1e6, 0)::BIGINT AS us FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY case_id, host ORDER BY us) AS k, count(*) OVER (PARTITION BY case_id, host) AS n FROM t),
aligned AS (SELECT *, concat('CLOCKS MAY DISAGREE: the median host access lies ', CASE WHEN g > 0 THEN '+' ELSE '' END, round_even(g, 0)::BIGINT,
    's from the median network event (algorithm: n/a). Host times should already be on the common clock; links in time are unreliable here and were not shifted.') AS note
  FROM (SELECT case_id, (max(us) FILTER (host) - max(us) FILTER (NOT host)) / 1e6 AS g FROM r WHERE k = n // 2 + 1 GROUP BY 1) WHERE abs(g) > 120)"""
_GATED = """g AS (SELECT t.*, m.mode, m.pinned, (t.kind = 'beacon' AND NOT m.clock_ok AND NOT t.hit AND t.tier IN ('strong', 'confirmed'))
  AS cap FROM tiered t LEFT JOIN man m USING (case_id))"""
SQL["gate_findings"] = sql("intel", "find", "man", body=f""", {_GATED}
SELECT case_id, seq, CASE WHEN cap THEN 'weak' ELSE tier END AS confidence_tier, CASE WHEN cap THEN 'clock_quality' END
  AS capped_by_caveat, CASE WHEN mode = 'simulated' THEN 'simulated_inetsim' END AS network_mode, false AS plaintext_available FROM g""")
SQL["case_notes"] = sql("intel", "find", "man", "acc", body=f""", {_GATED}, c AS (SELECT case_id, count(*) AS n FROM g WHERE cap GROUP BY 1),
{_CAPPED}, k AS (SELECT case_id, count(*) FILTER (NOT clock_ok) AS links, count(*) FILTER (clock_ok) AS blind_n FROM b WHERE cap GROUP BY 1),
{_ALIGNED},
x AS (SELECT m.*, coalesce(c.n, 0) AS n, coalesce(k.links, 0) AS links, coalesce(k.blind_n, 0) AS blind_n FROM man m LEFT JOIN c USING (case_id) LEFT JOIN k USING (case_id))
SELECT case_id, 'network' AS gate, 'network_simulated' AS code, NULL::BIGINT AS affected, 'NETWORK SIMULATED: what was contacted was only attempted, nothing was delivered. Finding no upload does not clear the sample.' AS note FROM x WHERE mode = 'simulated'
UNION ALL SELECT case_id, 'network', 'network_live', NULL, concat('NETWORK LIVE (mode ''', raw_mode, '''): contacted destinations were reached; a blocked one cannot be told from one never tried.') FROM x WHERE mode = 'real'
UNION ALL SELECT case_id, 'network', 'network_unrecognised', NULL, concat('NETWORK MODE UNKNOWN (''', raw_mode, '''): missing uploads allow no conclusion.') FROM x WHERE mode = 'unknown'
UNION ALL SELECT case_id, 'network', 'clock_quality', n, concat('CLOCKS NOT RELIABLE: ', n, ' timing finding(s) lowered to weak.') FROM x WHERE NOT clock_ok
UNION ALL SELECT case_id, 'network', 'tls_not_intercepted', NULL, 'TLS NOT READABLE (certificate_rejected): only metadata of encrypted traffic was judged.' FROM x WHERE pinned
UNION ALL SELECT case_id, 'network', 'tls_intercepted', NULL, 'TLS READABLE: decrypted payloads were at hand.' FROM x WHERE NOT pinned
UNION ALL SELECT case_id, 'correlation', 'correlation_clock', links, concat('CLOCKS NOT RELIABLE: ', links, ' link(s) between host and network lowered to weak.')
  FROM x WHERE NOT clock_ok AND links > 0
UNION ALL SELECT case_id, 'correlation', 'telemetry_degraded', blind_n, concat('TELEMETRY INCOMPLETE (providers missing: ',
    CASE WHEN providers = '' THEN 'unspecified' WHEN providers = 'Kernel-File' THEN 'Kernel-File' ELSE providers END,
    '): missing host data proves nothing for [', CASE WHEN blind_all THEN 'all data types' ELSE blind END, ']; ', blind_n, ' link(s) lowered to weak.')
  FROM x WHERE degraded
UNION ALL SELECT case_id, 'clock', 'clock_alignment', NULL, note FROM aligned
UNION ALL SELECT case_id, 'handoff', 'correlation_disabled', NULL, concat('SANDBOX SWITCHED OFF HOST-NETWORK LINKS: ', coalesce(reason, 'not stated')) FROM x WHERE NOT corr_ok""")

SQL["static_prior_match"] = sql("conn", "dns", "ioc", body="""
SELECT i.case_id, i.seq, i.type, i.value, h.matched IS NOT NULL AS observed, coalesce(h.matched, '') AS matched, i.config
FROM ioc i LEFT JOIN hits h USING (case_id, seq)""")
SQL["static_prior_tiers"] = sql("conn", "dns", "intel", "find", body="""
, seen AS (SELECT case_id, dst_ip AS key FROM conn UNION SELECT case_id, lower(query) FROM dns
  UNION SELECT case_id, dst_ip FROM find UNION SELECT case_id, lower(domain) FROM find WHERE domain IS NOT NULL), """
  + CTE["ioc"].replace("seen AS (SELECT case_id, dst_ip AS key FROM conn UNION SELECT case_id, lower(query) FROM dns),\n", "") + """,
mk AS (SELECT k.case_id, k.key, max(CASE WHEN family IS NULL THEN '' ELSE concat(' (', family, ')') END) AS fam
  FROM keyed k SEMI JOIN seen USING (case_id, key) JOIN ioc USING (case_id, seq) GROUP BY 1, 2),
p AS (SELECT t.*, coalesce(a.fam, b.fam) AS fam FROM tiered t LEFT JOIN mk a ON a.case_id = t.case_id AND a.key = t.dst_ip
  LEFT JOIN mk b ON b.case_id = t.case_id AND b.key = lower(t.domain)),
x AS (SELECT i.*, h.matched IS NOT NULL AS obs, CASE WHEN i.family IS NULL THEN '' ELSE concat(' (', i.family, ')') END AS f,
  CASE WHEN config THEN 'decrypted from the sample''s configuration' ELSE 'found as a string inside the sample' END AS how,
  (EXISTS (SELECT 1 FROM find q WHERE q.case_id = i.case_id AND q.dst_ip IN (i.value, lower(i.value)))
   OR EXISTS (SELECT 1 FROM find q WHERE q.case_id = i.case_id AND lower(q.domain) IN (i.value, lower(i.value)))) AS known
  FROM ioc i LEFT JOIN hits h USING (case_id, seq))
SELECT case_id, seq, kind, dst_ip, domain AS destination_domain, 0.5 AS confidence,
  CASE WHEN fam IS NOT NULL THEN 'confirmed' ELSE tier END AS confidence_tier, hit OR fam IS NOT NULL AS reputation_hit,
  CASE WHEN fam IS NOT NULL THEN concat('matches static-extracted C2', fam) END AS static_match, NULL::VARCHAR AS static_note FROM p
UNION ALL
SELECT case_id, seq, 'static_ioc', CASE WHEN type = 'ip' THEN value ELSE '' END, CASE WHEN type <> 'ip' THEN value END,
  CASE WHEN obs AND config THEN 0.9 WHEN obs THEN 0.7 WHEN config THEN 0.8 ELSE 0.4 END,
  CASE WHEN obs AND config THEN 'confirmed' WHEN obs OR config THEN 'strong' ELSE 'weak' END, obs,
  CASE WHEN obs THEN concat('C2', f, ' ', how, ' and contacted on network') END,
  CASE WHEN NOT obs THEN concat('Address', f, ' ', how, '; not observed on the network (dormant)') END FROM x WHERE NOT obs OR NOT known""")

SQL["correlate_pairs"] = sql("acc", body=f"""
SELECT case_id, access_seq, network_seq, data_type AS data_type_accessed, access_ts, dst_ip AS destination_ip,
  dst_port AS destination_port, {rnd('delta', 2)} AS time_delta_s, {rnd('conf', 2)} AS network_confidence, rep AS reputation_hit,
  score AS correlation_confidence, tier AS confidence_tier, technique AS mitre_technique_id, obj AS accessed_object FROM graded""")
SQL["correlate_best"] = sql("acc", body=f"""
SELECT case_id, access_seq, network_seq, data_type AS data_type_accessed, access_ts, dst_ip AS destination_ip,
  dst_port AS destination_port, {rnd('delta', 2)} AS time_delta_s, score AS correlation_confidence, tier AS confidence_tier FROM best""")
SQL["clock_sync"] = sql("acc", body=f""",
ix AS (SELECT a.case_id, min(n.us - a.us) / 1e6 AS g FROM acc a JOIN net n ON a.case_id = n.case_id AND n.us >= a.us GROUP BY 1),
c AS (SELECT DISTINCT a.case_id, ix.g FROM acc a LEFT JOIN ix USING (case_id))
SELECT case_id, {rnd('g', 2)} AS min_forward_delta_s, coalesce(g <= 15, false) AS correlatable, coalesce(g > 15, false) AS likely_skew,
  CASE WHEN g <= 15 THEN 'clocks appear aligned' WHEN g > 15 THEN concat('no access→network pair within 15s; closest is ',
    ({rnd('g', 1)})::VARCHAR, 's — likely clock skew or misaligned captures')
  ELSE 'no network events occur after any access event; either no exfil followed the accesses, or timelines don''t overlap' END AS note
FROM c""")
SQL["clock_alignment"] = f"WITH {_ALIGNED} SELECT case_id, round(g, 6) AS gap_s, note FROM aligned"
SQL["gate_correlated"] = sql("acc", "man", body=f""", {_CAPPED}
SELECT case_id, access_seq, data_type AS data_type_accessed, CASE WHEN cap THEN 'weak' ELSE tier END AS confidence_tier,
  CASE WHEN cap THEN CASE WHEN NOT clock_ok THEN 'clock_quality' ELSE 'telemetry_degraded' END END AS capped_by_caveat FROM b""")

CTE["meta"] = """meta AS (
  SELECT concat('case-', c_custkey) AS case_id, sha256(c_custkey::VARCHAR) AS sample_sha256,
    CASE WHEN c_custkey % 10 <> 0 THEN c_nationkey::DOUBLE END AS static_risk_score,
    CASE WHEN c_nationkey % 5 = 0 THEN 'AgentTesla' WHEN c_nationkey % 3 = 0 THEN 'RedLine Stealer'
      WHEN c_custkey % 14 = 0 THEN 'Remcos' END AS family,
    concat_ws('|', CASE WHEN c_nationkey % 5 = 0 THEN 'yara_deep:x,MAL_Agent-Tesla' WHEN c_nationkey % 3 = 0 THEN 'yara_fast:Win_RedLine_1' END,
      CASE WHEN c_custkey % 7 = 0 THEN CASE WHEN c_custkey % 14 = 0 THEN 'clamav:Win.Trojan.Remcos' ELSE 'clamav:detected' END END,
      CASE c_custkey % 4 WHEN 0 THEN 'virustotal:54/72' WHEN 3 THEN 'virustotal:3 / 60' END) AS signals,
    CASE WHEN c_custkey % 12 = 0 THEN '' ELSE 'T1027.002,T1113' END AS techniques,
    concat_ws('|', CASE WHEN c_custkey % 10 = 0 THEN 'static_risk_score is not numeric' END,
      CASE WHEN c_custkey % 12 = 0 THEN 'static_hypotheses must be an array' END) AS errors FROM customer)"""
SQL["sample_meta"] = sql("meta", body="SELECT * FROM meta")
SQL["static_promotion"] = sql("acc", "meta", body=""",
b AS (SELECT best.*, meta.signals, (best.tier = 'strong' AND access_seq % 5 <> 0 AND meta.signals <> '' AND meta.errors = '') AS lift
  FROM best LEFT JOIN meta USING (case_id))
SELECT case_id, access_seq, CASE WHEN lift THEN 'confirmed' ELSE tier END AS confidence_tier, CASE WHEN lift THEN signals END AS signals FROM b""")

CTE["prov"] = """fs AS (SELECT case_id, dst_ip, dst_port, arg_min(kind, seq) AS kind, arg_min(coalesce(domain, ''), seq) AS domain,
    arg_min(plain, seq) AS plain, arg_min(coalesce(uri, ''), seq) AS uri FROM net GROUP BY 1, 2, 3),
art AS (SELECT concat('case-', event_id % 7) AS case_id, concat('198.51.100.', user_id) AS dst_ip, floor(value * 10)::BIGINT AS total_bytes,
    sha256(event_id::VARCHAR) AS sha256, concat('item ', event_id) AS preview FROM events WHERE event_type IN ('purchase', 'signup')
    QUALIFY row_number() OVER (PARTITION BY event_id % 7, user_id ORDER BY floor(value * 10) DESC, event_id) = 1),
pr AS (SELECT b.case_id, b.access_seq, CASE b.data_type WHEN 'browser_credentials' THEN 'credential'
      WHEN 'keystrokes' THEN CASE WHEN f.uri <> '' THEN 'otp' ELSE 'keystroke_log' END
      WHEN 'clipboard' THEN CASE WHEN f.uri <> '' THEN 'otp' ELSE 'clipboard_data' END WHEN 'file_access' THEN 'file'
      ELSE b.data_type END AS item_type, b.data_type AS data_type_accessed, b.api_call AS accessed_via, b.access_ts AS accessed_at,
    b.dst_ip AS destination_ip, b.dst_port AS destination_port, nullif(f.domain, '') AS destination_domain,
    CASE f.kind WHEN 'exfil' THEN 'FTP/HTTP' ELSE 'HTTP' END AS exfil_protocol, round_even(b.delta * 100.0, 0) / 100.0 AS time_delta_s,
    nullif(f.uri, '') AS evidence, NOT f.plain AS inferred,
    CASE WHEN b.tier = 'weak' AND f.domain = 'events.data.microsoft.com' THEN 'allowlisted' ELSE b.tier END AS confidence_tier,
    coalesce(art.total_bytes, 0) AS recovered_bytes, art.sha256 AS recovered_sha256, art.preview AS recovered_preview,
    b.obj AS accessed_object
  FROM best b JOIN fs f USING (case_id, dst_ip, dst_port) LEFT JOIN art ON art.case_id = b.case_id AND art.dst_ip = b.dst_ip)"""
SQL["provenance"] = sql("acc", "prov", body="SELECT * FROM pr")
SQL["provenance_statements"] = sql("acc", "prov", body="""
SELECT case_id, access_seq, CASE WHEN confidence_tier = 'allowlisted'
  THEN concat(item_type, coalesce(' ' || accessed_object, ''), ' via ', accessed_via, ' was read at ', accessed_at, '; regular background traffic to ',
    coalesce(destination_domain, destination_ip), ' came at T (+', time_delta_s::VARCHAR, 's). ', coalesce(destination_domain, destination_ip),
    ' is known to be harmless, so no transfer is claimed. [allowlisted]')
  ELSE concat(item_type, coalesce(' ' || accessed_object, ''), ' via ', accessed_via, ', read at ', accessed_at, ', ',
    CASE WHEN inferred THEN 'probably went' ELSE 'went' END, ' to ', coalesce(destination_domain, destination_ip),
    ' by ', exfil_protocol, ' at T (+', time_delta_s::VARCHAR, 's) [', confidence_tier, ']', CASE WHEN recovered_bytes > 0
      THEN concat(', ', recovered_bytes, ' bytes recovered (sha256 ', substr(recovered_sha256, 1, 12), '…)') ELSE '' END) END AS statement FROM pr""")
SQL["timeline"] = sql("acc", body="""
SELECT case_id, round(ts, 4) AS event_time, seq, 'host' AS actor, CASE technique WHEN 'T1082' THEN 'discovery' ELSE 'collection' END AS phase,
  technique AS mitre, concat('host accessed ', data_type, ' via ', api_call) AS description, NULL::VARCHAR AS tier FROM acc
UNION ALL
SELECT case_id, round(ts, 4), seq, 'network', CASE kind WHEN 'exfil' THEN 'exfiltration' ELSE 'command-and-control' END,
  CASE kind WHEN 'exfil' THEN 'T1041' ELSE 'T1071.001' END, concat(kind, ' to ', coalesce(domain, dst_ip)), tier FROM net""")

_FAMILY_CASE = " UNION ALL ".join(
    f"SELECT case_id, '{f}' AS family, txt FROM tx WHERE " + " OR ".join(f"contains(lower(txt), '{k}')" for k in keys)
    for f, keys in vocab.FAMILY_KEYWORDS.items()
)
CTE["fam"] = f"""tx AS (
  SELECT case_id, note AS txt FROM tiered WHERE note IS NOT NULL
  UNION SELECT case_id, ip_note FROM tiered WHERE ip_hit
  UNION SELECT case_id, dom_note FROM tiered WHERE dom_hit),
fm AS ({_FAMILY_CASE}),
beh AS (SELECT case_id, bool_or(kind = 'dns_tunnel') AS d, bool_or(kind = 'http_c2') AND bool_or(kind = 'beacon') AS g,
  bool_or(kind = 'smtp_exfil') AS m FROM find GROUP BY 1),
stated AS (SELECT concat('case-', c_custkey % 7) AS case_id, max(CASE WHEN c_nationkey % 2 = 0 THEN 'RedLine' END) AS family FROM customer GROUP BY 1),
fam AS (
  SELECT DISTINCT case_id, family, 'likely' AS confidence, 'threat_intel' AS basis, concat('threat-intel note: ', txt) AS evidence FROM fm
  UNION ALL SELECT case_id, 'dnscat2', 'possible', 'behavioural', 'DNS tunnelling (TXT/MX/CNAME, high-entropy subdomains)' FROM beh WHERE d
  UNION ALL SELECT case_id, 'Cobalt Strike', 'possible', 'behavioural', 'HTTP C2 gate + periodic beacon' FROM beh WHERE g
  UNION ALL SELECT case_id, 'AgentTesla', 'possible', 'behavioural', 'credential/system-info exfil over SMTP/FTP' FROM beh WHERE m
  UNION ALL SELECT case_id, family, 'confirmed', 'static_prior', 'family extracted from the binary by static analysis' FROM stated
    WHERE family IS NOT NULL)"""
SQL["family"] = sql("intel", "find", "fam", body="SELECT * FROM fam")
SQL["family_verdicts"] = sql("intel", "find", "fam", body=""", r AS (SELECT *, CASE confidence WHEN 'confirmed' THEN 3 WHEN 'likely' THEN 2 ELSE 1 END AS rk FROM fam)
SELECT case_id, family, arg_max(confidence, rk) AS confidence, arg_max(basis, rk) AS basis, max(rk) AS rank, count(*) AS evidence_count,
  min(evidence) AS first_evidence FROM r GROUP BY 1, 2""")

SQL["family_evidence"] = sql("intel", "find", "fam", body=""", r AS (SELECT *, CASE confidence WHEN 'confirmed' THEN 3 WHEN 'likely' THEN 2 ELSE 1 END AS rk FROM fam)
SELECT case_id, family, row_number() OVER (PARTITION BY case_id, family ORDER BY rk DESC, evidence)::INT AS place, confidence, basis, evidence FROM r""")

SQL["hash_chain"] = sql("chain", recursive=True, body="SELECT case_id, event_id, pos AS chain_pos, h AS evidence_hash FROM chained")
SQL["chain_verify"] = """WITH ev AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos FROM events),
c AS (SELECT concat('user-', user_id) AS case_id, count(*) AS rows, min(pos) FILTER (user_id % 3 = 0 AND pos % 20 = 7) AS f FROM ev GROUP BY 1)
SELECT case_id, rows, f IS NULL AS is_valid, coalesce(f, -1) AS first_broken FROM c"""
SQL["chain_tamper"] = """WITH c AS (SELECT user_id, user_id % 6 AS way, count(*) AS n FROM events GROUP BY 1, 2),
f AS (SELECT *, CASE WHEN way = 1 THEN 0 WHEN way = 2 AND n >= 8 THEN 7 WHEN way = 3 THEN n - 1 WHEN way = 4 AND n > 3 THEN 3
    WHEN way = 5 AND n > 5 THEN 5 END AS first_bad FROM c)
SELECT concat('user-', user_id) AS case_id, first_bad IS NULL AS is_valid, coalesce(first_bad, -1)::BIGINT AS first_broken,
  (n + CASE WHEN way IN (1, 3) OR (way = 2 AND n >= 8) THEN -1 WHEN way = 4 AND n > 3 THEN 1 ELSE 0 END)::BIGINT AS rows FROM f"""
SQL["chain_segments"] = """WITH RECURSIVE ev AS (
  SELECT concat('user-', user_id) AS case_id, concat(event_id, '|', event_type, '|', floor(value * 100)::BIGINT) AS txt,
    CASE WHEN user_id % 2 = 0 THEN sha256(user_id::VARCHAR) ELSE repeat('0', 64) END AS seed,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos FROM events),
c AS (SELECT case_id, pos, seed, sha256(concat(CASE WHEN pos = 0 THEN seed ELSE sha256(concat(seed, ':', pos // 16)) END, txt)) AS h
    FROM ev WHERE pos % 16 = 0
  UNION ALL SELECT e.case_id, e.pos, e.seed, sha256(concat(c.h, e.txt)) FROM c JOIN ev e ON e.case_id = c.case_id AND e.pos = c.pos + 1
    WHERE e.pos % 16 <> 0),
tails AS (SELECT case_id, pos // 16 AS seg, arg_max(h, pos) AS h, any_value(seed) AS seed, max(pos) + 1 AS upto FROM c GROUP BY 1, 2),
s AS (SELECT case_id, seg, sha256(concat(seed, h)) AS seal FROM tails WHERE seg = 0
  UNION ALL SELECT t.case_id, t.seg, sha256(concat(s.seal, t.h)) FROM s JOIN tails t ON t.case_id = s.case_id AND t.seg = s.seg + 1),
n AS (SELECT case_id, max(upto) AS rows, count(*) AS segments FROM tails GROUP BY 1)
SELECT n.case_id, n.rows, n.segments, s.seal FROM n JOIN s ON s.case_id = n.case_id AND s.seg = n.segments - 1"""
SQL["case_manifest"] = """WITH i AS (SELECT concat('case-', doc_id // 10) AS case_id, sha256(text) AS h, strlen(text) AS s FROM documents)
SELECT case_id, count(*) AS inputs, sum(s)::BIGINT AS total_bytes,
  sha256(concat('{"inputs":["', string_agg(h, '","' ORDER BY h), '"],"parameters":{}}')) AS manifest_id FROM i GROUP BY 1"""

SQL["evidence_hashes"] = """SELECT concat('case-', doc_id % 50) AS case_id, 'sample' AS role,
  sha256(string_agg(coalesce(text, '') || chr(10), '' ORDER BY doc_id)) AS sha256, sum(strlen(coalesce(text, '')) + 1)::BIGINT AS size_bytes
FROM documents GROUP BY 1"""

SQL["ioc_export"] = sql("intel", "find", "evt", body="""
SELECT case_id, ip AS destination_ip, 443 AS destination_port, domain AS destination_domain, final AS confidence_tier,
  0.5 AS confidence_score, note AS reputation_note, source AS reputation_source, technique AS mitre_technique_id,
  concat('T', seq) AS timestamp, evidence_hash FROM evt WHERE final <> 'allowlisted'
QUALIFY row_number() OVER (PARTITION BY case_id, coalesce(ip, domain) ORDER BY seq) = 1""")


def uuid5(name: str) -> str:
    digest = f"sha1(unhex('{vocab.UUID_URL_NAMESPACE}') || encode({name}))"
    variant = f"substr('89ab', (('0x' || substr({digest}, 17, 1))::INT % 4) + 1, 1)"
    return (
        f"concat(substr({digest}, 1, 8), '-', substr({digest}, 9, 4), '-5', substr({digest}, 14, 3), '-', {variant}, "
        f"substr({digest}, 18, 3), '-', substr({digest}, 21, 12))"
    )


_STIX = f"""o AS (SELECT *, CASE WHEN ip IS NOT NULL THEN concat('ip:', ip) ELSE concat('domain:', domain) END AS ob,
  CASE WHEN ip IS NOT NULL THEN concat('IP: ', ip) ELSE concat('domain: ', domain) END AS label,
  {uuid5('seq::VARCHAR')} AS eid FROM evt WHERE final <> 'allowlisted' AND (ip IS NOT NULL OR domain IS NOT NULL)),
w AS (SELECT *, concat('indicator--', {uuid5('ob')}) AS iid, concat('observed-data--', eid) AS oid FROM o),
f AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY case_id, ob ORDER BY seq) = 1),
obj AS (
SELECT case_id, 'indicator' AS type, iid AS id, concat('Malicious ', label, coalesce(' — ' || note, '')) AS name,
  concat(CASE WHEN ip IS NOT NULL THEN concat(ip, ':443') ELSE domain END, ': graded ', final, ' by netforensics. ',
    CASE WHEN note IS NOT NULL THEN concat('Known as ', note, ' according to ', coalesce(source, 'n/a'), '. ') ELSE '' END,
    'Technique: ', coalesce(technique, 'none'), '.') AS description,
  CASE WHEN ip IS NOT NULL THEN concat('[ipv4-addr:value = ''', ip, ''']') ELSE concat('[domain-name:value = ''', domain, ''']') END AS pattern,
  'stix' AS pattern_type, concat('T', seq) AS valid_from, CASE final WHEN 'confirmed' THEN '95' WHEN 'strong' THEN '75' ELSE '40' END AS confidence,
  '["malicious-activity"]' AS labels, CASE WHEN technique IS NOT NULL THEN concat('[{{"source_name":"mitre-attack","external_id":"', technique,
    '","url":"https://attack.mitre.org/techniques/', replace(technique, '.', '/'), '/"}}]') END AS external_references,
  NULL::VARCHAR AS first_observed, NULL::VARCHAR AS last_observed, NULL::VARCHAR AS number_observed, NULL::VARCHAR AS object_refs,
  NULL::VARCHAR AS relationship_type, NULL::VARCHAR AS source_ref, NULL::VARCHAR AS target_ref FROM f
UNION ALL SELECT case_id, 'observed-data', oid, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, concat('T', seq), concat('T', seq), '1', '[]', NULL, NULL, NULL FROM w
UNION ALL SELECT case_id, 'relationship', concat('relationship--', {uuid5("concat(iid, '|', oid)")}), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  NULL, NULL, NULL, 'based-on', iid, oid FROM w)"""
SQL["stix_objects"] = sql("intel", "find", "evt", body=f""", {_STIX}
SELECT *, '2.1' AS spec_version, '2026-01-01T00:00:00+00:00' AS created, '2026-01-01T00:00:00+00:00' AS modified FROM obj""")
SQL["stix_bundles"] = sql("intel", "find", "evt", body=f""", {_STIX}
SELECT case_id, concat('bundle--', {uuid5('case_id')}) AS bundle_id, type, id, name, pattern, source_ref, target_ref FROM obj""")

_DEST = """CASE WHEN domain IS NOT NULL AND ip IS NOT NULL THEN concat(domain, ' (', ip, ')') WHEN domain IS NOT NULL THEN domain
  WHEN ip IS NOT NULL THEN concat(ip, ':443') ELSE 'a destination that could not be identified' END"""
SQL["plain_language"] = sql("intel", "find", "evt", body=f""",
d AS (SELECT *, {_DEST} AS dest, CASE WHEN seq % 4 = 0 THEN ' in DE' ELSE '' END AS geo FROM evt)
SELECT case_id, seq, CASE kind WHEN 'beacon' THEN 'beacon' WHEN 'dns_tunnel' THEN 'dns' WHEN 'http_c2' THEN
    CASE WHEN hit THEN 'reputation' ELSE 'exfil' END ELSE 'exfil' END AS finding_kind,
  concat(CASE kind WHEN 'beacon' THEN concat('The sample called ', dest, geo, ' at steady intervals, as programs do that wait for remote orders.')
    WHEN 'dns_tunnel' THEN concat('The sample made name lookups for ', dest, ' of a kind that ordinary programs do not make.')
    WHEN 'http_c2' THEN concat('The sample transferred data to ', dest, geo, '.')
    ELSE concat('The sample sent data from this computer to ', dest, geo, '.') END,
    CASE WHEN hit THEN concat(' Threat intelligence lists this destination (', note, ').') ELSE '' END,
    CASE final WHEN 'allowlisted' THEN ' It was examined and found to be normal activity.'
      WHEN 'weak' THEN ' It is listed for review only; nothing is confirmed.' ELSE '' END) AS plain_language FROM d""")
SQL["evidence_refs"] = sql("intel", "find", "evt", body="""
SELECT case_id, seq, concat('[{"type":"network_event","detector":"', kind, '"', CASE WHEN ip IS NOT NULL THEN concat(',"destination_ip":"', ip, '"') ELSE '' END,
  ',"destination_port":443', CASE WHEN domain IS NOT NULL THEN concat(',"destination_domain":"', domain, '"') ELSE '' END,
  ',"timestamp":"T', seq, '"}', CASE WHEN source IS NOT NULL THEN concat(',{"type":"threat_intel","source":"', source, '","note":"', note, '"}') ELSE '' END, ']')
  AS evidence_refs FROM evt""")
SQL["contract_violations"] = f"""WITH e AS (SELECT o_orderkey AS k, {uuid5('o_orderkey::VARCHAR')} AS event_id FROM orders)
SELECT event_id, 'timestamp' AS field, 'required' AS rule FROM e WHERE k % 19 = 0
UNION ALL SELECT event_id, 'case_id', 'pattern' FROM e WHERE k % 17 = 0
UNION ALL SELECT event_id, 'manifest_sha256', 'pattern' FROM e WHERE k % 29 = 0
UNION ALL SELECT event_id, 'platform', 'enum' FROM e WHERE k % 11 = 0
UNION ALL SELECT event_id, 'destination_port', 'range' FROM e WHERE k % 13 = 0
UNION ALL SELECT event_id, 'plain_language', 'length' FROM e WHERE k % 23 = 0"""
SQL["sample_tiers"] = sql("intel", "find", "evt", body=""",
b AS (SELECT sha256(case_id) AS sample_id, max(CASE final WHEN 'confirmed' THEN 4 WHEN 'strong' THEN 3 WHEN 'weak' THEN 2 ELSE 0 END) AS r FROM evt GROUP BY 1)
SELECT sample_id, 'windows' AS platform, CASE r WHEN 4 THEN 'confirmed' WHEN 3 THEN 'strong' WHEN 2 THEN 'weak' ELSE 'allowlisted' END AS confidence_tier FROM b
UNION ALL SELECT sha256(concat('case-', n_nationkey)), 'windows', 'weak' FROM nation WHERE sha256(concat('case-', n_nationkey)) NOT IN (SELECT sample_id FROM b)""")
SQL["new_events"] = sql("intel", "find", "evt", body=f"""
SELECT case_id, {uuid5('seq::VARCHAR')} AS event_id, ip AS destination_ip, final AS confidence_tier FROM evt
WHERE seq NOT IN (SELECT l_orderkey FROM lineitem)""")

CTE["flag"] = """flag AS (SELECT DISTINCT case_id, unnest(CASE tier WHEN 'confirmed' THEN ['confirmed', 'strong+', 'any'] WHEN 'strong' THEN ['strong+', 'any']
    ELSE ['any'] END) AS threshold, CASE WHEN kind = 'dns_tunnel' AND domain IS NOT NULL THEN domain ELSE dst_ip END AS indicator FROM tiered),
truth AS (SELECT concat('case-', c) AS case_id, value AS indicator FROM intel, range(0, 5) r(c) WHERE indicator_type = 'ip'),
grid AS (SELECT concat('case-', c) AS case_id, c < 5 AS is_malware, t AS threshold FROM range(0, 8) r(c), (SELECT unnest(['confirmed', 'strong+', 'any']) AS t)
  WHERE EXISTS (SELECT 1 FROM intel WHERE indicator_type = 'ip')),
cnt AS (SELECT g.case_id, g.threshold, g.is_malware,
    (SELECT count(*) FROM flag f WHERE f.case_id = g.case_id AND f.threshold = g.threshold AND EXISTS (SELECT 1 FROM truth t WHERE t.case_id = f.case_id AND t.indicator = f.indicator)) AS tp,
    (SELECT count(*) FROM flag f WHERE f.case_id = g.case_id AND f.threshold = g.threshold) AS flagged,
    (SELECT count(*) FROM truth t WHERE t.case_id = g.case_id) AS wanted FROM grid g)"""
SQL["flagged_indicators"] = sql("intel", "find", "flag", body="SELECT * FROM flag")
SQL["case_outcomes"] = sql("intel", "find", "flag", body="""
SELECT case_id, threshold, is_malware, tp, flagged - tp AS fp, wanted - tp AS fn, CASE WHEN tp > 0 THEN 'HIT' ELSE 'miss' END AS outcome FROM cnt""")
SQL["precision_recall"] = sql("intel", "find", "flag", body=""",
s AS (SELECT threshold, sum(tp)::BIGINT AS tp, sum(flagged - tp)::BIGINT AS fp, sum(wanted - tp)::BIGINT AS fn FROM cnt GROUP BY 1)
SELECT *, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 1.0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0.0 END, 6) AS recall FROM s""")

SQL["ngram_features"] = sql("dns", "label", body="SELECT feature, count(*) AS names, round(sum(value), 6) AS total FROM feat GROUP BY 1")
SQL["dga_vocabulary"] = sql("dns", "label", body=""", d AS (SELECT feature, count(*) AS df FROM feat GROUP BY 1)
SELECT * FROM (SELECT * FROM d WHERE feature LIKE 'ng:%' AND df >= 3 ORDER BY df DESC, feature LIMIT 200)
UNION ALL SELECT * FROM d WHERE feature LIKE 'f:%'""")
SQL["dga_score"] = sql("dns", "label", body=f""", z AS (SELECT name, -0.25 + sum(value * (((ascii(substr(feature, 4, 1)) % 7) - 3) * 2.0)) AS z FROM feat GROUP BY 1)
SELECT name, {rnd('1 / (1 + exp(-z))', 4)} AS probability, 1 / (1 + exp(-z)) >= 0.5 AS is_dga FROM z""")

SQL["zeek_conn"] = sql("sess", body="""
SELECT case_id, seq, ts, src_ip, src_port, dst_ip, dst_port, proto, CASE WHEN orig_bytes % 7000 = 0 THEN 0 ELSE orig_bytes END AS orig_bytes,
  resp_bytes, history, uid FROM sess""")
SQL["zeek_connections"] = sql("sess", body="""
SELECT case_id, dst_ip, dst_port, count(*) AS n, sum(CASE WHEN orig_bytes % 7000 = 0 THEN 0 ELSE orig_bytes END)::BIGINT AS orig_bytes
FROM sess GROUP BY 1, 2, 3""")

SQL["zeek_dns"] = sql("dns", body="""
SELECT case_id, seq, dst_ip, query, qtype, rcode, CASE seq % 3 WHEN 0 THEN concat('[x] ', qtype) WHEN 1 THEN dst_ip ELSE '' END AS answers FROM dns""")
SQL["zeek_http"] = sql("phttp", body="""
SELECT case_id, seq, dst_ip, (CASE WHEN seq % 11 = 0 THEN 80 ELSE dst_port END)::INT AS dst_port, method, nullif(host, '') AS host,
  nullif(uri, '') AS uri, nullif(user_agent, '') AS user_agent, (CASE seq % 3 WHEN 0 THEN 404 WHEN 2 THEN 200 END)::INT AS status_code,
  (CASE WHEN seq % 2 = 0 THEN seq ELSE 0 END)::BIGINT AS req_body_len, seq::BIGINT AS resp_body_len FROM phttp""")
SQL["zeek_ftp"] = sql("oftp", body="""
SELECT case_id, seq, src_ip, dst_ip, command, arg, (CASE WHEN seq % 2 = 0 THEN 226 END)::INT AS reply_code, uid FROM oftp""")
SQL["zeek_smtp"] = """SELECT concat('case-', conv_id % 7) AS case_id, conv_id * 1000 + turn AS seq,
  CASE WHEN conv_id % 8 <> 0 THEN concat('U', conv_id % 9, '@Example.com') END AS mail_from,
  CASE WHEN conv_id % 16 = 0 THEN '' ELSE concat('u', turn % 9, '@example.com c', conv_id, '@drop.example') END AS rcpt_to,
  concat('conversation ', conv_id, ' ', role) AS subject, CASE WHEN conv_id % 16 % 3 = 0 THEN 'F1 F2' ELSE '' END AS attachments
FROM conversations"""
SQL["zeek_files"] = """SELECT concat('case-', event_id % 7) AS case_id, event_id AS seq,
  CASE WHEN event_id % 5 <> 0 THEN concat('item ', event_id) END AS filename, floor(value * 10)::BIGINT AS total_bytes,
  sha256(event_id::VARCHAR) AS sha256, concat('10.0.0.', user_id) AS source_ip,
  CASE WHEN event_id % 4 <> 0 THEN concat('198.51.100.', user_id) END AS dest_ip,
  concat('C', event_id, CASE WHEN event_id % 7 % 2 = 0 THEN ',D' ELSE '' END) AS uid FROM events"""

CTE["rawacc"] = """rawacc AS (SELECT concat('case-', event_id % 7) AS case_id, event_id AS seq, user_id, event_id % 9 AS m,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, epoch(date_trunc('second', ts)) AS sec,
    CASE user_id % 8 WHEN 0 THEN 'keystrokes' WHEN 1 THEN 'clipboard' WHEN 2 THEN 'bad_type' ELSE 'file_access' END AS data_type FROM events),
chk AS (SELECT *, CASE WHEN m = 2 THEN 'missing required field ''timestamp''' WHEN seq % 31 = 0 THEN 'missing required field ''api_call'''
    WHEN m = 1 THEN 'unparseable ISO-8601 timestamp ''yesterday''' WHEN m = 0 THEN concat('timestamp ''', iso, ''' has no timezone')
    WHEN data_type = 'bad_type' THEN 'invalid data_type ''bad_type''' END AS error FROM rawacc)"""
SQL["access_ingest"] = sql("rawacc", body="""
SELECT case_id, seq, CASE WHEN error IS NULL THEN sec END AS ts, data_type, CASE data_type WHEN 'keystrokes' THEN 'T1056.001' WHEN 'clipboard' THEN 'T1115'
  WHEN 'file_access' THEN 'T1005' END AS mitre_technique, concat('C:/f', user_id) AS object_path, NULL::VARCHAR AS object_name,
  CASE WHEN seq % 2 = 0 THEN user_id::INT END AS process_id, error FROM chk""")
SQL["access_report"] = sql("rawacc", body="""
SELECT case_id, count(*) FILTER (error IS NULL) AS valid, count(*) FILTER (error IS NOT NULL) AS rejected FROM chk GROUP BY 1""")
SQL["static_prior_ingest"] = """WITH c AS (SELECT concat('case-', c_custkey) AS case_id, concat('h', c_custkey) AS sample_sha256,
  CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'G' END AS family, c_nationkey AS n, c_custkey AS k FROM customer)
SELECT case_id, 0::BIGINT AS seq, sample_sha256, family, 'ip' AS type, concat('1.2.3.', n) AS value, 'cape_config' AS source, NULL::VARCHAR AS error FROM c
UNION ALL SELECT case_id, 1, sample_sha256, family, 'mutex', 'm', NULL, 'c2_indicators[1] invalid type ''mutex''' FROM c
UNION ALL SELECT case_id, 2, sample_sha256, family, NULL, 'v', NULL, 'c2_indicators[2] must have ''type'' and ''value''' FROM c
UNION ALL SELECT case_id, 3, sample_sha256, family, 'domain', '', NULL, 'c2_indicators[3] empty value' FROM c
UNION ALL SELECT case_id, 4, sample_sha256, family, 'url', concat('http://x', k, '.example/g'), NULL, NULL FROM c"""
SQL["handoff_manifest"] = sql("man", body="""
SELECT case_id, concat('s', k) AS session_id, k AS cape_task_id, mode, clock_ok AS clock_quality_acceptable, degraded AS telemetry_degraded, providers,
  guest AS guest_ip, corr_ok AS host_network_correlation_enabled, reason AS correlation_reason, 'behavior/access_events.json' AS access_events_path,
  pinned, blind AS blind_types, blind_all AS blind_everywhere FROM man""")
SQL["clock_quality"] = """SELECT concat('case-', s_suppkey) AS case_id, u / 1e6 AS clock_uncertainty_ms, 'linear' AS algorithm,
  s_suppkey % 2 = 0 AS acceptable, u / 1e6 / 1000.0 AS slack_s FROM (SELECT *, CASE WHEN s_suppkey % 3 = 0 THEN 502000000
  ELSE greatest(s_suppkey * 1000000, s_nationkey * 2000000) END::DOUBLE AS u FROM supplier)"""

CTE["feodo"] = f"""feodo AS (SELECT {address('c_custkey')} AS value, 'abuse.ch/FeodoTracker' AS source,
  concat(c_mktsegment, ' C2 (port ', 400 + c_nationkey, ')') AS note, 'ip' AS indicator_type, '2026-01-01' AS last_seen, c_custkey AS seq
  FROM customer WHERE c_custkey % 50 <> 0 AND c_custkey % 51 <> 0)"""
CTE["urlhaus"] = f"""uh AS (SELECT page_id AS seq, CASE WHEN page_id % 5 = 1 THEN concat('203.0.113.', page_id % 250) ELSE {HOST} END AS value,
    CASE WHEN page_id % 5 = 1 THEN 'ip' ELSE 'domain' END AS indicator_type, concat('d', page_id) AS last_seen,
    CASE WHEN page_id % 2 = 0 THEN 'malware_download (exe)' ELSE 'malware_download' END AS note FROM pages
  WHERE page_id % 40 <> 0 AND page_id % 5 NOT IN (0, 2)),
urlhaus AS (SELECT value, 'abuse.ch/URLhaus' AS source, note, indicator_type, last_seen, seq FROM uh)"""
CTE["fox"] = f"""fox AS (SELECT CASE o_orderkey % 5 WHEN 0 THEN {address('o_custkey')} WHEN 1 THEN concat('c', o_custkey, '.example.com')
    ELSE concat('198.51.100.', o_custkey % 250) END AS value, 'abuse.ch/ThreatFox' AS source,
  concat(CASE WHEN o_orderkey % 4 = 0 THEN 'win.x' ELSE 'Remcos' END, ' C2', CASE WHEN o_orderkey % 5 = 0 THEN concat(' (port ', 1000 + o_orderkey % 9, ')') ELSE '' END) AS note,
  CASE WHEN o_orderkey % 5 = 1 THEN 'domain' ELSE 'ip' END AS indicator_type, concat('d', o_orderkey) AS last_seen, o_orderkey AS seq
  FROM orders WHERE o_orderkey % 5 IN (0, 1, 4))"""
SQL["feed_feodo"] = sql("feodo", body="SELECT * FROM feodo")
SQL["feed_urlhaus"] = sql("urlhaus", body="SELECT * FROM urlhaus")
SQL["feed_threatfox"] = sql("fox", body="SELECT * FROM fox")
SQL["feed_list"] = """SELECT concat('evil', s_suppkey % 40, '.example') AS value, 'custom' AS source, 'domain blocklist' AS note,
  'domain' AS indicator_type, s_suppkey AS seq FROM supplier WHERE s_suppkey % 9 <> 0"""
_SEEDS = " UNION ALL ".join(
    [f"SELECT '{v}' AS value, '{s}' AS source, '{n}' AS note, 'ip' AS indicator_type, NULL::VARCHAR AS last_seen, 0 AS rk, 0 AS seq"
     for v, s, n in vocab.DEMO_INDICATORS]
    + [f"SELECT '{v}', 'known_bad_ja3', '{d}', 'ja3', NULL, 1, 0" for v, d in vocab.KNOWN_BAD_JA3]
)
SQL["feed_refresh"] = sql("feodo", "urlhaus", "fox", body=f""",
u AS ({_SEEDS}
  UNION ALL SELECT concat('c', s_suppkey, '.example.com'), 'feed/dga', 'domain blocklist', 'domain', NULL, 2, s_suppkey FROM supplier
  UNION ALL SELECT value, source, note, indicator_type, last_seen, 3, seq FROM feodo
  UNION ALL SELECT value, source, note, indicator_type, last_seen, 4, seq FROM fox
  UNION ALL SELECT value, source, note, indicator_type, last_seen, 5, seq FROM urlhaus)
SELECT value, source, note, indicator_type, last_seen FROM u QUALIFY row_number() OVER (PARTITION BY value ORDER BY rk DESC, seq DESC) = 1""")
SQL["intel_counts"] = sql("intel", body="SELECT indicator_type, count(*) AS indicators FROM intel GROUP BY 1")
SQL["ground_truth"] = """WITH s AS (SELECT *, s_suppkey % 4 <> 0 AS mal FROM supplier)
SELECT concat('cap', s_suppkey) AS case_id, mal AS is_malware, concat('d', s_suppkey, '.example') AS indicator FROM s WHERE mal
UNION ALL SELECT concat('cap', s_suppkey), mal, concat('1.2.3.', s_nationkey) FROM s WHERE mal AND s_nationkey % 3 <> 0
UNION ALL SELECT concat('cap', s_suppkey), mal, NULL FROM s WHERE NOT mal"""

SQL["dga_learned"] = sql("dns", "label", body=f""",
z AS (SELECT name, 1 / (1 + exp(-(-0.25 + sum(value * (((ascii(substr(feature, 4, 1)) % 7) - 3) * 2.0))))) AS p FROM feat GROUP BY 1),
d AS (SELECT case_id, {registered('lower(query)')} AS domain, dst_ip, count(*) AS n, min(seq) AS f FROM dns GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY case_id, domain ORDER BY n DESC, f) AS rk FROM d),
c AS (SELECT case_id, domain, sum(n)::BIGINT AS query_count, string_agg(dst_ip, ',' ORDER BY rk) FILTER (rk <= 3) AS resolvers FROM r GROUP BY 1, 2)
SELECT case_id, 'dga_ml' AS kind, domain, query_count, length(name)::DOUBLE AS avg_sub_len,
  {rnd('round_even(p * 10000.0, 0) / 10000.0', 2)} AS confidence, resolvers
FROM c JOIN z ON z.name = string_split(c.domain, '.')[1] WHERE length(name) >= 8 AND round_even(p * 10000.0, 0) / 10000.0 >= 0.6""")
SQL["zeek_ssl"] = sql("ptls", body="""
SELECT case_id, src_ip, dst_ip, dst_port, ja3, ja3s, CASE WHEN seq % 7 = 0 THEN NULL ELSE server_name END AS server_name,
  CASE WHEN seq % 3 = 0 THEN NULL ELSE subject END AS subject FROM ptls
QUALIFY row_number() OVER (PARTITION BY case_id, src_ip, dst_ip, dst_port ORDER BY seq DESC) = 1""")
_FLOW = """o AS (SELECT *, first_value(up) OVER (PARTITION BY case_id, client, server, port ORDER BY seq, ts, up) AS first_up,
  (server LIKE '192.168.%') AS inside FROM p),
f AS (SELECT *, CASE WHEN NOT inside THEN up ELSE up = first_up END AS fwd,
  CASE WHEN inside AND NOT first_up THEN false ELSE true END AS normal FROM o),
flow AS (SELECT case_id, min(seq) AS seq, CASE WHEN normal THEN client ELSE server END AS src_ip,
  CASE WHEN normal THEN server ELSE client END AS dst_ip, CASE WHEN normal THEN 443 ELSE port END AS dst_port,
  coalesce(sum(length(payload)) FILTER (fwd), 0)::BIGINT AS orig_bytes, coalesce(sum(length(payload)) FILTER (NOT fwd), 0)::BIGINT AS resp_bytes,
  max(CASE WHEN fwd AND rf = 'R' THEN 'POST' END) AS method, arg_max(host, seq) FILTER (fwd AND rf = 'R') AS host,
  arg_max(concat('/gate.php?p=', part), seq) FILTER (fwd AND rf = 'R') AS uri,
  arg_min(concat('STOR|part', part, '.zip'), seq) FILTER (fwd AND rf = 'N') AS store
  FROM f GROUP BY case_id, client, server, port, normal)"""
_NOT_LOGGED = "case_id NOT IN (SELECT concat('case-', r_regionkey) FROM region)"
SQL["packet_tables"] = sql("pkt", "dns", "hello", body=f""", p AS (SELECT * FROM pkt WHERE {_NOT_LOGGED}), {_FLOW}
SELECT case_id, 'sessions' AS table_name, seq, dst_ip, concat_ws('|', src_ip, dst_port, orig_bytes, resp_bytes) AS detail FROM flow
UNION ALL SELECT case_id, 'http', seq, dst_ip, concat_ws('|', method, host, uri) FROM flow WHERE method IS NOT NULL
UNION ALL SELECT case_id, 'ftp', seq, dst_ip, store FROM flow WHERE store IS NOT NULL
UNION ALL SELECT case_id, 'dns', seq, dst_ip, concat_ws('|', query, CASE WHEN qtype = 'TXT' THEN 'TXT' ELSE 'A' END,
  CASE WHEN rcode = 'NXDOMAIN' THEN 'NXDOMAIN' ELSE 'NOERROR' END) FROM dns WHERE seq % 10 <> 0 AND {_NOT_LOGGED}
UNION ALL SELECT case_id, 'tls', seq, host, concat_ws('|', sni, ja3, ja4) FROM
  (SELECT * FROM printed WHERE message = 'client' AND {_NOT_LOGGED} QUALIFY row_number() OVER (PARTITION BY case_id, host ORDER BY seq) = 1)
UNION ALL SELECT case_id, 'icmp', seq, CASE WHEN up THEN server ELSE client END, length(payload)::VARCHAR FROM p WHERE seq % 9 IN (0, 1)""")
SQL["case_sources"] = sql("sess", "pkt", body=f""", p AS (SELECT * FROM pkt WHERE case_id IN ('case-4', 'case-5', 'case-6')), {_FLOW}
SELECT case_id, 'logs' AS source, src_ip, dst_ip, dst_port, orig_bytes, resp_bytes FROM sess WHERE case_id NOT IN ('case-4', 'case-5', 'case-6')
UNION ALL SELECT case_id, 'capture', src_ip, dst_ip, dst_port, orig_bytes, resp_bytes FROM flow""")
SQL["object_labels"] = """WITH n AS (SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM documents)
SELECT doc_id, CASE WHEN t = '' THEN NULL WHEN length(t) <= 160 THEN t ELSE concat(substr(t, 1, 78), '...', substr(t, length(t) - 77)) END AS label FROM n"""

SQL["dga_split"] = """WITH p AS (
  SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS name, 0 AS label FROM documents
  UNION ALL SELECT unnest(list_transform(list_zip(w[1:len(w) - 1], w[2:]), lambda x: x[1] || x[2])), 1
  FROM (SELECT regexp_extract_all(lower(text), '[a-z]+') AS w FROM conversations) WHERE len(w) > 1),
n AS (SELECT name, min(label) AS label FROM p GROUP BY 1)
SELECT CASE WHEN ('0x' || substr(md5(name), 1, 7))::BIGINT % 10000 < 8500 THEN 'train' ELSE 'held_out' END AS part, label::INT AS label,
  count(*) AS names, sum(length(name))::BIGINT AS letters FROM n GROUP BY 1, 2"""
SQL["manifest_sidecars"] = """SELECT concat('case-', n_nationkey) AS case_id, greatest(n_nationkey * 1000000, n_regionkey * 5000000) / 1e6 AS clock_uncertainty_ms,
  concat('a', n_regionkey) AS clock_algorithm, n_nationkey % 2 = 0 AS clock_quality_reported, concat('etw', n_regionkey) AS access_events_source,
  n_nationkey % 3 <> 0 AS access_events_correlation_eligible, (n_nationkey % 4)::INT AS access_events_rejected_count,
  CASE WHEN n_nationkey % 3 = 2 THEN 'r' ELSE concat('c', n_nationkey) END AS correlation_reason FROM nation"""
SQL["allowlist_file"] = f"""SELECT 'domain' AS kind, unnest([{_list(vocab.ALLOWLIST_DOMAINS)}]) AS value
UNION SELECT 'domain', concat('site', s_suppkey, '.com') FROM supplier UNION SELECT 'domain', 'all.example' FROM supplier
UNION SELECT 'cidr', concat('203.0.', s_nationkey, '.0/24') FROM supplier WHERE s_suppkey % 5 <> 0"""
SQL["infrastructure_removal"] = sql("conn", "dns", "ioc", "ohttp", body="""
SELECT case_id, seq, type, value FROM ioc ANTI JOIN (SELECT DISTINCT case_id, dst_ip AS value, 'ip' AS type FROM ohttp) USING (case_id, type, value)""")
SQL["event_sinks"] = sql("intel", "find", "evt", body=f"""
SELECT unnest(['table', 'json', 'store']) AS sink, case_id, {uuid5('seq::VARCHAR')} AS event_id, final AS confidence_tier, seq AS chain_pos FROM evt""")
SQL["feed_guard"] = SQL["feed_refresh"].replace(
    "SELECT value, source, note, indicator_type, last_seen FROM u QUALIFY row_number() OVER (PARTITION BY value ORDER BY rk DESC, seq DESC) = 1",
    "SELECT count(DISTINCT value) AS indicators, 500 AS minimum, count(DISTINCT value) >= 500 AS enough FROM u")
SQL["correlated_events"] = sql("acc", body="""
, fs AS (SELECT case_id, dst_ip, dst_port, arg_min(kind, seq) AS kind, arg_min(coalesce(domain, ''), seq) AS domain, arg_min(plain, seq) AS plain FROM net GROUP BY 1, 2, 3),
e AS (SELECT b.*, f.kind, nullif(f.domain, '') AS domain, f.plain, CASE WHEN b.tier = 'weak' AND f.domain = 'events.data.microsoft.com' THEN 'allowlisted' ELSE b.tier END AS graded,
  round_even(b.delta * 100.0, 0) / 100.0 AS d, make_timestamp(n_us) AS moment, n_us % 1000000 AS fraction FROM best b JOIN fs f USING (case_id, dst_ip, dst_port)),
x AS (SELECT *, concat(strftime(moment, '%Y-%m-%dT%H:%M:%S'), CASE WHEN fraction <> 0 THEN concat('.', lpad(fraction::VARCHAR, 6, '0')) ELSE '' END, '+00:00') AS stamp,
  acc.user_id FROM e JOIN (SELECT case_id, seq AS access_seq, user_id FROM acc) acc USING (case_id, access_seq))
SELECT case_id, sha256(case_id) AS sample_id, access_seq, dst_ip AS destination_ip, dst_port AS destination_port, domain AS destination_domain, plain AS plaintext_available,
  score AS confidence_score, graded AS confidence_tier, 'correlation' AS finding_kind,
  concat('On this computer the sample accessed ', CASE WHEN obj IS NULL THEN replace(data_type, '_', ' ') WHEN data_type = 'file_access' THEN concat('the file ', obj)
      ELSE concat(replace(data_type, '_', ' '), ' from ', obj) END, '; ', regexp_replace(d::VARCHAR, '\\.0$', ''), ' seconds afterwards it was in contact with ',
    CASE WHEN domain IS NOT NULL THEN concat(domain, ' (', dst_ip, ')') ELSE concat(dst_ip, ':', dst_port) END, '.',
    CASE WHEN graded = 'allowlisted' THEN ' It was examined and found to be normal activity.' WHEN graded IN ('weak', 'unconfirmed')
      THEN ' It is listed for review only; nothing is confirmed.' ELSE '' END) AS plain_language,
  concat('[{"type":"network_event","detector":"', kind, '","destination_ip":"', dst_ip, '","destination_port":', dst_port,
    CASE WHEN domain IS NOT NULL THEN concat(',"destination_domain":"', domain, '"') ELSE '' END, ',"timestamp":"', stamp, '"},{"type":"host_access","data_type":"', data_type,
    '","api_call":"', api_call, '","time_delta_s":', d::VARCHAR, CASE WHEN obj IS NOT NULL THEN concat(',"object_path":"', obj, '"') ELSE '' END,
    ',"process":"proc', user_id % 5, '.exe","process_id":', user_id, '}]') AS evidence_refs FROM x""")

# --- the whole analysis ------------------------------------------------------------------

_GUEST_OF = "(r.g IS NULL OR src_ip = r.g OR dst_ip = r.g)"
_IN = _GUEST_OF + " AND ts >= 788918400 AND ts <= 1893456000"
_BACKGROUND = (
    f"(NOT list_has_any({suffixes('domain')}, [{_list(vocab.ABUSED_HOSTS)}]) AND list_has_any({suffixes('domain')}, [{_list(vocab.OS_BACKGROUND)}])"
    f" OR domain IN ({_list(vocab.ALLOWLIST_DOMAINS)}) OR {registered('domain')} IN ({_list(vocab.ALLOWLIST_DOMAINS)}))"
)
CTE["scoped"] = f"""{_GUEST.format(t='sess')},
r AS (SELECT m.case_id, coalesce(m.guest, x.guest_ip) AS g, m.mode, m.clock_ok FROM man m LEFT JOIN guest x USING (case_id)),
c_sess AS (SELECT s.* FROM sess s JOIN r USING (case_id) WHERE {_IN}),
c_http AS (
  SELECT h.case_id, seq, src_ip, dst_ip, dst_port, method, host, uri, NULL::VARCHAR AS user_agent, uid FROM ohttp h JOIN r USING (case_id) WHERE {_IN}
  UNION ALL SELECT p.case_id, seq, src_ip, dst_ip, dst_port, method, host, uri, user_agent, NULL FROM phttp p JOIN r USING (case_id) WHERE {_IN}),
c_ftp AS (SELECT f.* FROM oftp f JOIN r USING (case_id) WHERE {_IN}),
c_dns AS (SELECT d.* FROM dns d JOIN r USING (case_id) WHERE {_IN}),
c_tls AS (SELECT t.* FROM ptls t JOIN r USING (case_id) WHERE {_IN}),
c_icmp AS (SELECT i.* FROM (
  SELECT concat('case-', event_id % 2) AS case_id, event_id AS seq, '10.0.0.5' AS src_ip, CASE WHEN event_type = 'error' THEN floor(value)::INT ELSE 56 END AS len,
    concat(CASE WHEN event_type = 'error' THEN '198.51.' ELSE '198.52.' END, user_id // 250, '.', user_id % 250) AS dst_ip FROM events) i
  JOIN r USING (case_id) WHERE {_GUEST_OF}),
c_mail AS (SELECT m.* FROM (
  SELECT concat('case-', conv_id % 7) AS case_id, conv_id * 1000 + turn AS seq, 1704067200.0 + conv_id AS ts, concat('10.0.0.', conv_id % 200 + 1) AS src_ip,
    concat('198.51.100.', conv_id % 50) AS dst_ip, conv_id % 16 = 0 AS empty, concat('u', turn % 9, '@example.com') AS r1,
    concat('c', conv_id, '@drop.example') AS r2, length(text) % 3 = 0 AS att, CASE WHEN role <> 'user' THEN concat('bot', conv_id % 5, '@service.example')
      WHEN conv_id % 8 <> 0 THEN concat('U', conv_id % 9, '@Example.com') END AS mail_from FROM conversations) m JOIN r USING (case_id) WHERE {_IN}),
up AS (SELECT *, trim(concat(command, ' ', arg)) AS stored FROM c_ftp WHERE upper(command) IN ('STOR', 'STOU', 'APPE')),
hu AS (SELECT * FROM c_http WHERE uid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY case_id, uid ORDER BY seq) = 1),
hk AS (SELECT * FROM c_http QUALIFY row_number() OVER (PARTITION BY case_id, src_ip, dst_ip, dst_port ORDER BY seq, method, host, uri) = 1),
fu AS (SELECT * FROM up WHERE uid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY case_id, uid ORDER BY seq) = 1),
fk AS (SELECT * FROM up QUALIFY row_number() OVER (PARTITION BY case_id, src_ip, dst_ip ORDER BY seq) = 1),
cc AS (
  SELECT s.case_id, s.seq, s.ts, s.src_ip, s.dst_ip, s.dst_port, s.orig_bytes, s.resp_bytes, s.history,
    CASE WHEN hu.seq IS NOT NULL THEN hu.method ELSE hk.method END AS http_method, CASE WHEN hu.seq IS NOT NULL THEN hu.host ELSE hk.host END AS http_host,
    coalesce(fu.stored, fk.stored) AS ftp_upload_cmd,
    CASE WHEN s.orig_bytes + s.resp_bytes > 0 THEN s.orig_bytes / (s.orig_bytes + s.resp_bytes)::DOUBLE ELSE 0 END AS ratio
  FROM c_sess s LEFT JOIN hu ON hu.case_id = s.case_id AND hu.uid = s.uid
    LEFT JOIN hk ON hk.case_id = s.case_id AND hk.src_ip = s.src_ip AND hk.dst_ip = s.dst_ip AND hk.dst_port = s.dst_port
    LEFT JOIN fu ON fu.case_id = s.case_id AND fu.uid = s.uid
    LEFT JOIN fk ON fk.case_id = s.case_id AND fk.src_ip = s.src_ip AND fk.dst_ip = s.dst_ip),
infra AS (SELECT DISTINCT case_id, dst_ip FROM dns UNION SELECT case_id, g FROM r WHERE g IS NOT NULL),
responder AS (SELECT DISTINCT c.case_id, c.dst_ip FROM c_sess c JOIN r USING (case_id) WHERE r.mode = 'simulated' AND (r.g IS NULL OR src_ip = r.g)
  AND {private('c.dst_ip')} AND c.dst_ip NOT LIKE '%.0' AND c.dst_ip NOT LIKE '%.255' AND (c.case_id, c.dst_ip) NOT IN (SELECT (case_id, dst_ip) FROM infra)),
pub AS (SELECT cc.* FROM cc LEFT JOIN responder x USING (case_id, dst_ip) WHERE NOT {private('dst_ip')} OR x.dst_ip IS NOT NULL)"""

CTE["candidates"] = f"""rec AS (SELECT case_id, src_ip, dst_ip, dst_port, min(seq) AS f, arg_max(server_name, seq) AS sni FROM c_tls GROUP BY 1, 2, 3, 4),
fp AS (SELECT case_id, dst_ip, dst_port, sni FROM rec QUALIFY row_number() OVER (PARTITION BY case_id, dst_ip, dst_port ORDER BY f) = 1),
hh AS (SELECT case_id, dst_ip, arg_min(lower(http_host), seq) AS h FROM cc WHERE contains(http_host, '.') GROUP BY 1, 2),
fx AS (SELECT *, http_method IS NOT DISTINCT FROM 'POST' AND orig_bytes >= 1024 AS big FROM pub),
vol AS (SELECT * FROM fx WHERE big OR (orig_bytes >= CASE WHEN http_method IS NOT DISTINCT FROM 'POST' THEN 1024 ELSE 204800 END AND ratio >= 0.7)),
ftp AS (SELECT * FROM pub WHERE ftp_upload_cmd IS NOT NULL QUALIFY row_number() OVER (PARTITION BY case_id, dst_ip
  ORDER BY seq, src_ip, dst_port, orig_bytes, resp_bytes, ftp_upload_cmd) = 1),
exf AS (SELECT case_id, seq, dst_ip, dst_port, http_method IS NOT NULL AS plain, {rnd("0.5 + CASE WHEN big THEN 0.3 ELSE 0 END + CASE WHEN ratio >= 0.7 THEN 0.2 ELSE 0 END", 2)} AS conf FROM vol
  UNION ALL SELECT case_id, seq, dst_ip, dst_port, true, 0.8 FROM ftp ANTI JOIN vol USING (case_id, dst_ip, dst_port)),
bi AS (SELECT *, ts - lag(ts) OVER (PARTITION BY case_id, dst_ip, dst_port ORDER BY ts) AS iv, (resp_bytes > 0 OR regexp_matches(history, '[a-z]')) AS answered FROM pub),
bs AS (SELECT case_id, dst_ip, dst_port, count(*) AS n, avg(iv) AS m, coalesce(stddev_pop(iv), 0) AS sd, avg(orig_bytes) AS mz, stddev_pop(orig_bytes) AS sz,
  count(*) FILTER (answered) AS a FROM bi GROUP BY 1, 2, 3 HAVING count(*) >= 4),
bj AS (SELECT *, CASE WHEN m > 0 THEN sd / m ELSE 1.0 END AS jit, CASE WHEN mz > 0 THEN sz / mz ELSE 0.0 END AS cv FROM bs),
bea AS (SELECT case_id, dst_ip, dst_port, CASE WHEN a = 0 THEN 'weak' END AS preset, {rnd("""least((1 - jit / 0.25) * 0.55 + least(n / 10.0, 1.0) * 0.35
    + CASE WHEN cv < 0.1 THEN 0.1 ELSE 0.0 END, CASE WHEN a = 0 THEN 0.3 ELSE 1.0 END)""", 2)} AS conf FROM bj WHERE jit <= 0.25 AND m >= 1.0),
tp AS (SELECT t.*, i.value IS NOT NULL OR j.value IS NOT NULL AS hit FROM c_tls t LEFT JOIN intel i ON i.value = t.dst_ip LEFT JOIN intel j ON j.value = t.ja3
  WHERE NOT {private('t.dst_ip')}),
th AS (SELECT * FROM tp WHERE hit QUALIFY row_number() OVER (PARTITION BY case_id, dst_ip ORDER BY seq) = 1),
tc AS (SELECT t.*, CASE WHEN t.subject = t.issuer THEN 'strong' ELSE 'weak' END AS preset FROM tp t LEFT JOIN th USING (case_id, dst_ip)
  WHERE (t.subject = t.issuer OR lower(coalesce(t.validation_status, '')) NOT IN ('', 'ok', '-')) AND (th.seq IS NULL OR t.seq < th.seq)),
""" + CTE["tunnel"].replace("FROM dns)", "FROM c_dns)") + f""",
rc AS (SELECT case_id, domain, dst_ip, count(*) AS c, min(seq) AS f FROM q GROUP BY 1, 2, 3),
rr AS (SELECT * FROM rc QUALIFY row_number() OVER (PARTITION BY case_id, domain ORDER BY c DESC, f) = 1),
dd AS (SELECT case_id, domain, count(*) AS n, count(*) FILTER (rcode = 'NXDOMAIN') AS nx FROM q GROUP BY 1, 2),
dc AS (SELECT case_id, count(*) FILTER (nx > 0) AS k, sum(nx) / sum(n)::DOUBLE AS share, avg({ent("string_split(domain, '.')[1]")}) FILTER (nx > 0) AS e FROM dd GROUP BY 1),
burst AS (SELECT case_id, concat('<', k, ' algorithmic domains>') AS domain FROM dc WHERE k >= 10 AND e >= 3.2 AND share >= 0.5),
own AS (SELECT case_id, lower(domain) AS parent FROM tunnels UNION SELECT case_id, lower(domain) FROM burst),
nm AS (SELECT DISTINCT case_id, {clean('query')} AS domain FROM c_dns WHERE contains({clean('query')}, '.')),
np AS (SELECT case_id, domain, unnest({suffixes('domain', 2)}) AS parent FROM nm),
nk AS (SELECT *, {_BACKGROUND} AS back FROM nm ANTI JOIN (SELECT case_id, domain FROM np SEMI JOIN own USING (case_id, parent)) USING (case_id, domain)),
ep AS (SELECT case_id, src_ip, dst_ip, dst_port, server_name AS host, 0 AS src, seq FROM c_tls UNION ALL SELECT case_id, src_ip, dst_ip, dst_port, host, 1, seq FROM c_http),
em AS (SELECT *, {clean('host')} AS h FROM ep WHERE host <> ''),
es AS (SELECT *, {_SERVICE} AS no FROM em),
ef AS (SELECT * FROM es WHERE no IS NOT NULL QUALIFY row_number() OVER (PARTITION BY case_id, dst_ip, host ORDER BY src, seq) = 1),
ls AS (SELECT * FROM c_sess QUALIFY row_number() OVER (PARTITION BY case_id, src_ip, dst_ip, dst_port ORDER BY seq DESC) = 1),
cl AS (SELECT f.case_id, f.seq, f.src, f.dst_ip, f.dst_port, f.host, [{_list(k for _, _, k in vocab.CLOUD_SERVICES)}][no] AS risk,
  coalesce(s.orig_bytes, 0) AS o, coalesce(s.resp_bytes, 0) AS i FROM ef f LEFT JOIN ls s USING (case_id, src_ip, dst_ip, dst_port)),
ml AS (SELECT *, coalesce(NOT empty AND lower(mail_from) IN (r1, r2), false) AS self FROM c_mail WHERE mail_from IS NOT NULL OR NOT empty),
wb AS (SELECT *, regexp_matches(uri, '{_GATE}') AS gate, coalesce(lower(trim(user_agent)) IN ({_list(vocab.SUSPICIOUS_AGENTS)}), false) AS ua FROM c_http),
wf AS (SELECT * FROM wb WHERE gate OR ua QUALIFY row_number() OVER (PARTITION BY case_id, dst_ip, uri ORDER BY seq) = 1),
ic AS (SELECT case_id, dst_ip, min(seq) AS seq FROM c_icmp GROUP BY 1, 2 HAVING count(*) >= 8 AND avg(len) >= 64),
pn AS (SELECT case_id, dst_ip, dst_port, 0 AS src, seq FROM c_http WHERE dst_port NOT IN ({', '.join(map(str, vocab.HTTP_PORTS))})
  UNION ALL SELECT case_id, dst_ip, dst_port, 1, seq FROM c_tls WHERE dst_port NOT IN ({', '.join(map(str, vocab.TLS_PORTS))})),
pm AS (SELECT case_id, dst_ip, dst_port, seq FROM pn QUALIFY row_number() OVER (PARTITION BY case_id, dst_ip, dst_port ORDER BY src, seq) = 1),
sn AS (SELECT case_id, dst_ip, arg_max(server_name, seq) AS sni FROM c_tls WHERE server_name <> '' GROUP BY 1, 2),
eg AS (SELECT case_id, dst_ip, dst_port, seq FROM pub WHERE orig_bytes >= 2048 AND ratio >= 0.6
  QUALIFY row_number() OVER (PARTITION BY case_id, dst_ip, dst_port ORDER BY seq, orig_bytes, ratio) = 1),
cand AS (
  SELECT e.case_id, 'exfil' AS kind, e.dst_ip, e.dst_port, coalesce(hh.h, fp.sni) AS domain, e.conf, NULL::VARCHAR AS preset,
    0 AS rank, e.seq AS seqno, '' AS name, true AS own, e.plain AS plain
    FROM exf e LEFT JOIN hh USING (case_id, dst_ip) LEFT JOIN fp ON fp.case_id = e.case_id AND fp.dst_ip = e.dst_ip AND fp.dst_port = e.dst_port
  UNION ALL SELECT b.case_id, 'beacon', b.dst_ip, b.dst_port, coalesce(hh.h, fp.sni), b.conf, b.preset, 1, NULL, concat(b.dst_ip, ':', b.dst_port), true, false
    FROM bea b LEFT JOIN hh USING (case_id, dst_ip) LEFT JOIN fp ON fp.case_id = b.case_id AND fp.dst_ip = b.dst_ip AND fp.dst_port = b.dst_port
  UNION ALL SELECT case_id, 'ja3', dst_ip, dst_port, server_name, 0.7, NULL, 2, seq, '', true, false FROM th
  UNION ALL SELECT case_id, 'tls_cert', dst_ip, dst_port, server_name, 0.6, preset, 2, seq, '', true, false FROM tc
  UNION ALL SELECT t.case_id, 'dns_tunnel', rr.dst_ip, 53, t.domain, {rnd('least(1.0, 0.5 + 0.15 * t.score)', 2)}, 'strong', 3, NULL, t.domain, false, true
    FROM tunnels t JOIN rr USING (case_id, domain)
  UNION ALL SELECT case_id, 'dga', '', 53, domain, 0.7, 'strong', 4, NULL, domain, false, true FROM burst
  UNION ALL SELECT case_id, 'resolved_domain', NULL, NULL, domain, CASE WHEN back THEN 0.0 ELSE 0.4 END, CASE WHEN back THEN 'allowlisted' ELSE 'weak' END,
    6, NULL, domain, false, false FROM nk
  UNION ALL SELECT case_id, CASE WHEN NOT (o > i * 1.2 AND o > 0) AND i > o THEN 'cloud_staging' ELSE 'cloud_exfil' END, dst_ip, dst_port, host,
    CASE risk WHEN 'high' THEN 0.75 ELSE 0.4 END, CASE risk WHEN 'high' THEN 'strong' ELSE 'weak' END, 7, seq, concat(src, '|', dst_ip, '|', host), false, false FROM cl
  UNION ALL SELECT case_id, 'smtp_exfil', dst_ip, 25, CASE WHEN NOT empty THEN r1 END,
    {rnd('0.6 + CASE WHEN att THEN 0.15 ELSE 0 END + CASE WHEN self THEN 0.15 ELSE 0 END', 2)}, CASE WHEN att OR self THEN 'strong' ELSE 'weak' END, 8, seq, '', false, true FROM ml
  UNION ALL SELECT case_id, 'http_c2', dst_ip, dst_port, host, CASE WHEN gate THEN 0.7 ELSE 0.45 END, CASE WHEN gate THEN 'strong' ELSE 'weak' END, 9, seq, '', false, true
    FROM wf WHERE NOT {private('dst_ip')}
  UNION ALL SELECT case_id, 'icmp_tunnel', dst_ip, 0, NULL, 0.75, 'strong', 10, seq, concat(dst_ip, ':0'), false, false FROM ic
  UNION ALL SELECT case_id, 'port_mismatch', dst_ip, dst_port, NULL, 0.4, 'weak', 11, seq, concat(dst_ip, ':', dst_port), false, false FROM pm WHERE NOT {private('dst_ip')}
  UNION ALL SELECT e.case_id, 'unclassified_egress', e.dst_ip, e.dst_port, sn.sni, 0.4, 'weak', 12, e.seq, '', false, false FROM eg e LEFT JOIN sn USING (case_id, dst_ip)),
ct AS (SELECT case_id, arg_min(ts, seq) AS first_ts FROM cc GROUP BY 1),
dt AS (SELECT case_id, min(ts) AS d FROM c_dns GROUP BY 1),
tm AS (SELECT coalesce(ct.case_id, dt.case_id) AS case_id, first_ts, coalesce(d, first_ts) AS case_ts FROM ct FULL JOIN dt ON ct.case_id = dt.case_id),
fs AS (SELECT case_id, dst_ip, dst_port, arg_min(ts, (seq, ts)) AS ts FROM cc GROUP BY 1, 2, 3),
kd AS (SELECT case_id, dst_ip, bool_or(kind IN ('exfil', 'beacon')) AS flow, bool_or(kind <> 'unclassified_egress') AS other FROM cand GROUP BY 1, 2),
fnd AS (SELECT c.* FROM cand c LEFT JOIN kd ON kd.case_id = c.case_id AND kd.dst_ip = c.dst_ip
  WHERE NOT coalesce(c.kind IN ('ja3', 'tls_cert') AND kd.flow, false) AND NOT coalesce(c.kind = 'unclassified_egress' AND kd.other, false)),
sk AS (SELECT case_id, dst_ip, count(DISTINCT kind) AS k FROM fnd WHERE dst_ip IS NOT NULL GROUP BY 1, 2),
rp AS (
  SELECT f.*, sk.k, i.value IS NOT NULL AS ip_hit, i.note AS ip_note, coalesce(f.domain, '') <> '' AND (d.value IS NOT NULL OR e.value IS NOT NULL) AS dom_hit,
    CASE WHEN d.value IS NOT NULL THEN d.note ELSE e.note END AS dom_note, i.source AS ip_source, CASE WHEN d.value IS NOT NULL THEN d.source ELSE e.source END AS dom_source,
    CASE WHEN f.own THEN coalesce(fs.ts, tm.first_ts, 0.0) ELSE coalesce(tm.case_ts, 0.0) END AS event_time
  FROM fnd f LEFT JOIN tm ON tm.case_id = f.case_id LEFT JOIN fs ON fs.case_id = f.case_id AND fs.dst_ip = f.dst_ip AND fs.dst_port = f.dst_port LEFT JOIN sk ON sk.case_id = f.case_id AND sk.dst_ip = f.dst_ip LEFT JOIN intel i ON i.value = f.dst_ip
    LEFT JOIN intel d ON d.value = {clean('f.domain')} LEFT JOIN intel e ON e.value = {registered(clean('f.domain'))}),
tr AS (
  SELECT case_id, kind, dst_ip, dst_port, domain, conf, ip_hit OR dom_hit AS hit, rank, seqno, name, plain, event_time,
    CASE WHEN ip_hit THEN ip_source WHEN dom_hit THEN dom_source END AS source, CASE WHEN ip_hit THEN ip_note WHEN dom_hit THEN concat('domain intel: ', dom_note) END AS note,
    CASE WHEN preset IS NOT NULL AND (ip_hit OR dom_hit) THEN 'confirmed' WHEN dom_hit AND NOT ip_hit THEN 'confirmed' WHEN preset IS NOT NULL THEN preset
      WHEN ip_hit THEN 'confirmed' WHEN k >= 2 THEN 'strong' ELSE 'weak' END AS tier FROM rp),
io AS (SELECT * FROM ioc ANTI JOIN (SELECT case_id, dst_ip AS value, 'ip' AS type FROM infra) USING (case_id, type, value)),
ik AS (SELECT case_id, seq, unnest(keys) AS key FROM io),
sx AS (
  SELECT case_id, dst_ip AS key FROM tr UNION SELECT case_id, dst_ip FROM cc ANTI JOIN infra USING (case_id, dst_ip)
  UNION SELECT case_id, lower(domain) FROM tr UNION SELECT case_id, lower(query) FROM c_dns),
ih AS (SELECT DISTINCT k.case_id, k.seq, k.key FROM ik k JOIN sx USING (case_id, key) WHERE key <> ''),
fm AS (SELECT h.case_id, h.key, max(CASE WHEN family IS NULL THEN '' ELSE concat(' (', family, ')') END) AS fam FROM ih h JOIN io USING (case_id, seq) GROUP BY 1, 2),
pr AS (SELECT t.*, coalesce(a.fam, b.fam) AS fam FROM tr t LEFT JOIN fm a ON a.case_id = t.case_id AND a.key = t.dst_ip
  LEFT JOIN fm b ON b.case_id = t.case_id AND b.key = lower(t.domain)),
kn AS (SELECT DISTINCT case_id, dst_ip AS value FROM tr WHERE dst_ip IS NOT NULL UNION SELECT case_id, lower(domain) FROM tr WHERE domain IS NOT NULL),
xi AS (SELECT i.*, EXISTS (SELECT 1 FROM ih WHERE ih.case_id = i.case_id AND ih.seq = i.seq) AS obs,
  EXISTS (SELECT 1 FROM kn WHERE kn.case_id = i.case_id AND kn.value IN (i.value, lower(i.value))) AS known,
  CASE WHEN i.family IS NULL THEN '' ELSE concat(' (', i.family, ')') END AS f,
  CASE WHEN config THEN 'decrypted from the sample''s configuration' ELSE 'found as a string inside the sample' END AS how FROM io i),
al AS (
  SELECT case_id, kind, dst_ip, dst_port, domain, conf, CASE WHEN fam IS NOT NULL THEN 'confirmed' ELSE tier END AS tier, hit OR fam IS NOT NULL AS hit, note,
    CASE WHEN fam IS NOT NULL THEN concat('matches static-extracted C2', fam) END AS matched, rank, seqno, name, plain, event_time, source FROM pr
  UNION ALL SELECT xi.case_id, 'static_ioc', CASE WHEN type = 'ip' THEN value ELSE '' END, 0, CASE WHEN type <> 'ip' THEN value END,
    CASE WHEN obs AND config THEN 0.9 WHEN obs THEN 0.7 WHEN config THEN 0.8 ELSE 0.4 END,
    CASE WHEN obs AND config THEN 'confirmed' WHEN obs OR config THEN 'strong' ELSE 'weak' END, obs, NULL,
    CASE WHEN obs THEN concat('C2', f, ' ', how, ' and contacted on network') END, 99, seq, value, false, tm.case_ts, NULL
    FROM xi LEFT JOIN tm ON tm.case_id = xi.case_id WHERE NOT obs OR NOT known),
lk AS (SELECT *, CASE WHEN tier = 'weak' THEN {_allow('domain', '')} END AS sanctioned FROM al),
gt AS (SELECT lk.*, CASE WHEN sanctioned IS NOT NULL THEN 'allowlisted' ELSE tier END AS graded, r.clock_ok FROM lk LEFT JOIN r USING (case_id)),
final AS (SELECT *, kind = 'beacon' AND NOT clock_ok AND NOT hit AND coalesce(matched, '') = '' AND graded IN ('strong', 'confirmed') AS cap FROM gt)"""
SQL["network_findings"] = sql("sess", "ohttp", "oftp", "dns", "phttp", "ptls", "man", "intel", body=""",
""" + CTE["ioc"].split(",\nseen AS")[0] + ",\n" + CTE["scoped"] + ",\n" + CTE["candidates"] + """
SELECT case_id, kind, dst_ip, dst_port::INT AS dst_port, domain AS destination_domain, conf AS confidence, CASE WHEN cap THEN 'weak' ELSE graded END AS confidence_tier,
  hit AS reputation_hit, note AS reputation_note, matched AS static_match, sanctioned AS allowlist_match, CASE WHEN cap THEN 'clock_quality' END AS capped_by_caveat
FROM final""")

_KINDS = "CASE " + " ".join(f"WHEN kind = '{k}' THEN '{v}'" for k, v in vocab.FINDING_KIND.items()) + " WHEN hit THEN 'reputation' ELSE 'exfil' END"
_TO = """CASE WHEN coalesce(domain, '') <> '' AND coalesce(dst_ip, '') <> '' THEN concat(domain, ' (', dst_ip, ')') WHEN coalesce(domain, '') <> '' THEN domain
  WHEN coalesce(dst_ip, '') <> '' AND coalesce(dst_port, 0) <> 0 THEN concat(dst_ip, ':', dst_port) WHEN coalesce(dst_ip, '') <> '' THEN dst_ip
  ELSE 'a destination that could not be identified' END"""
_STAMP = """concat(strftime(make_timestamp({us}), '%Y-%m-%dT%H:%M:%S'), CASE WHEN {us} % 1000000 <> 0 THEN concat('.', lpad(({us} % 1000000)::VARCHAR, 6, '0')) ELSE '' END, '+00:00')"""
_GRADE = """CASE WHEN coalesce(hit, false) AND coalesce(note, '') <> '' THEN concat(' Threat intelligence lists this destination (', note, ').') ELSE '' END,
  CASE WHEN tier = 'allowlisted' THEN ' It was examined and found to be normal activity.' WHEN tier IN ('weak', 'unconfirmed')
    THEN ' It is listed for review only; nothing is confirmed.' ELSE '' END"""
SQL["case_event_rows"] = sql("sess", "ohttp", "oftp", "dns", "phttp", "ptls", "man", "intel", body=""",
""" + CTE["ioc"].split(",\nseen AS")[0] + ",\n" + CTE["scoped"] + ",\n" + CTE["candidates"] + f""",
ne AS (SELECT *, round_even(event_time * 1e6, 0)::BIGINT AS us FROM (SELECT final.* EXCLUDE (tier), CASE WHEN cap THEN 'weak' ELSE graded END AS tier FROM final)),
ha AS (SELECT concat('case-', event_id % 7) AS case_id, event_id AS seq, round_even(epoch(ts) / 60 * 60 * 1e6, 0)::BIGINT AS us,
    concat('t', round_even(epoch(ts) / 60 * 1e6, 0)::BIGINT) AS raw, user_id,
    ['browser_credentials', 'keystrokes', 'screenshot', 'clipboard', 'crypto_wallet', 'system_info', 'file_access'][user_id % 7 + 1] AS data_type,
    ['T1555.003', 'T1056.001', 'T1113', 'T1115', 'T1005', 'T1082', 'T1005'][user_id % 7 + 1] AS technique,
    CASE WHEN event_type = 'click' THEN 'GetClipboardData' ELSE 'NtReadFile' END AS api_call,
    CASE WHEN user_id % 3 = 0 THEN concat('C:/Users/u', user_id, '/Login Data') WHEN user_id % 2 = 0 THEN 'Login Data' END AS obj
  FROM events WHERE event_type NOT IN ('purchase', 'signup')),
pq AS (SELECT a.case_id, a.seq AS access_seq, a.raw, a.data_type, a.technique, a.api_call, a.obj, n.us AS n_us, n.dst_ip, coalesce(n.dst_port, 0) AS dst_port, n.hit, n.rank, n.seqno,
    n.name, (n.us - a.us) / 1e6 AS delta,
    round_even(least((1.0 - ((n.us - a.us) / 1e6 / 15.0) * 0.5) * 0.5 + n.conf * 0.3 + CASE WHEN n.hit THEN 0.2 ELSE 0.0 END, 1.0) * 100.0, 0) / 100.0 AS score
  FROM ha a JOIN ne n ON a.case_id = n.case_id AND n.us BETWEEN a.us AND a.us + 15000000),
pb AS (SELECT * FROM pq QUALIFY row_number() OVER (PARTITION BY case_id, raw, data_type, api_call
  ORDER BY score DESC, n_us, access_seq, rank, seqno NULLS FIRST, name) = 1),
pc AS (SELECT pb.*, CASE WHEN hit AND score >= 0.6 THEN 'confirmed' WHEN score >= 0.6 THEN 'strong' WHEN score > 0 THEN 'weak' ELSE 'unconfirmed' END AS graded,
    m.clock_ok, m.degraded AND (m.blind_all OR data_type = m.blind) AS unseen FROM pb JOIN man m USING (case_id) WHERE m.corr_ok),
pd AS (SELECT *, NOT hit AND graded IN ('strong', 'confirmed') AND (NOT clock_ok OR unseen) AS cap FROM pc),
sv AS (SELECT * FROM ne WHERE dst_ip IS NOT NULL QUALIFY row_number() OVER (PARTITION BY case_id, dst_ip, dst_port ORDER BY rank, seqno NULLS FIRST, name) = 1),
pe AS (SELECT p.*, s.domain, s.note, s.source, s.plain, round_even(p.delta * 100.0, 0) / 100.0 AS d,
    CASE WHEN CASE WHEN p.cap THEN 'weak' ELSE p.graded END = 'weak' AND {_allow('s.domain', '')} IS NOT NULL THEN 'allowlisted' WHEN p.cap THEN 'weak' ELSE p.graded END AS tier
  FROM pd p LEFT JOIN sv s ON s.case_id = p.case_id AND s.dst_ip = p.dst_ip AND s.dst_port = p.dst_port),
lang AS (SELECT *, {_TO} AS dest FROM ne)
SELECT case_id, 1 AS stage, 0::BIGINT AS access_seq, {_STAMP.format(us='us')} AS timestamp, NULL::VARCHAR AS data_type_accessed, dst_ip AS destination_ip, dst_port::INT AS destination_port,
  domain AS destination_domain, CASE WHEN hit THEN 1.0 ELSE 0.0 END AS reputation_score, note AS reputation_note, source AS reputation_source, plain AS plaintext_available,
  conf AS confidence_score, tier AS confidence_tier, {technique('kind')} AS mitre_technique_id, {_KINDS} AS finding_kind,
  concat(CASE WHEN kind = 'static_ioc' THEN concat('The file carries ', dest, ' in its own code as an address to contact.')
    WHEN kind = 'beacon' THEN concat('The sample called ', dest, ' at steady intervals, as programs do that wait for remote orders.')
    WHEN kind IN ('dga', 'dga_ml', 'dns_tunnel') THEN concat('The sample made name lookups for ', dest, ' of a kind that ordinary programs do not make.')
    WHEN kind IN ('icmp_tunnel', 'port_mismatch') THEN concat('The sample passed data to ', dest, ' through a channel that is seldom used for it, which can hide it from monitoring.')
    WHEN kind IN ('exfil', 'smtp_exfil') THEN concat('The sample sent data from this computer to ', dest, '.')
    WHEN kind = 'resolved_domain' THEN concat('The sample asked for the address of ', dest, ', so it meant to reach it; no connection was seen.')
    WHEN kind = 'tls_cert' THEN concat('Encrypted traffic with ', dest, ' carries a mark that is known from malicious software.')
    ELSE concat('The sample transferred data to ', dest, '.') END, {_GRADE}) AS plain_language, CASE WHEN cap THEN 'clock_quality' END AS capped_by_caveat FROM lang
UNION ALL SELECT case_id, 0, access_seq, {_STAMP.format(us='n_us')}, data_type, dst_ip, dst_port::INT, domain, CASE WHEN hit THEN 1.0 ELSE 0.0 END, note, source, plain, score, tier,
  technique, 'correlation', concat('On this computer the sample accessed ', CASE WHEN obj IS NULL THEN replace(data_type, '_', ' ') WHEN data_type = 'file_access'
    THEN concat('the file ', obj) ELSE concat(replace(data_type, '_', ' '), ' from ', obj) END, '; ', regexp_replace(d::VARCHAR, '\\.0$', ''), ' seconds afterwards it was in contact with ',
    {_TO}, '.', {_GRADE}), CASE WHEN cap THEN CASE WHEN NOT clock_ok THEN 'clock_quality' ELSE 'telemetry_degraded' END END FROM pe""")
