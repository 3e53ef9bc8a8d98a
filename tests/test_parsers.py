import pytest

from quarry.operators.chunking import chunk_blocks, chunk_section, split_oversized
from quarry.sources import files, markup, xml_docs


def test_html():
    parsed = markup.parse_html(
        """<html><head><title>Vector  API</title><script>no</script></head><body><nav>no</nav><div class="sphinxsidebar"><h3>no</h3><p>no</div>
        <dialog><h2>no</h2></dialog><h1>Containers<a href="#c">¶</a><button id="copy-path">no</button></h1><p>Use <code>std::vector</code><br>carefully.
        <p>Second<p><dl><dt>Term<dd>Meaning</dl><h2>Example</h2><pre>a&lt;int&gt; v;\n  push();</pre><table><tr><th>Error<td>E23</table></body></html>""",
        "fallback",
    )
    assert parsed.title == "Vector API"
    assert [(b.heading_path, b.text, b.kind) for b in parsed.blocks] == [
        (["Containers"], "Use std::vector carefully.", "p"),
        (["Containers"], "Second", "p"),
        (["Containers"], "Term", "dt"),
        (["Containers"], "Meaning", "dd"),
        (["Containers", "Example"], "a<int> v;\n  push();", "code"),
        (["Containers", "Example"], "Error", "th"),
        (["Containers", "Example"], "E23", "td"),
    ]


def test_html_edges():
    kinds = lambda t: [(b.text, b.kind) for b in markup.parse_html(t, "f").blocks]
    assert kinds("<li>one<p>two</p>three</li>") == [("one", "li"), ("two", "p")]
    assert kinds("<p>a<nav><p>no</nav>b<img class=anchor>c</p>d") == [("abc", "p")]
    assert kinds("<p>x<br/>y<!-- <p>no --><b>z</b></p><td id=a CLASS='B c'>q") == [("x yz", "p"), ("q", "td")]
    assert markup.parse_html("<td id=a class='B'>q", "f").blocks[0].attributes == {"id": "a", "class": "B"}
    assert markup.parse_html("<title></title><h2>T ¶</h2><p>x", "f").title == "T" and markup.parse_html("", "f") == ("f", [], "html")


def test_markdown():
    parsed = markup.parse_markdown("# Guide\n\nIntro.\n\n<!-- no -->\nConfigure\n---\n\n```powershell\ncmake --preset x\n```\n\n    code here\n", "f")
    assert parsed.title == "Guide"
    assert [(b.heading_path, b.text, b.kind, b.attributes) for b in parsed.blocks] == [
        (["Guide"], "Intro.", "paragraph", {}),
        (["Guide", "Configure"], "cmake --preset x", "code", {"language": "powershell"}),
        (["Guide", "Configure"], "code here", "code", {}),
    ]
    assert markup.parse_markdown("% podman-run 1\n\n## NAME\nruns\n", "f").title == "podman-run"


def test_markdown_templates():
    source = "---\ntitle: 'Probes'\nlicense: no\n---\n\n{{< comment >}}\nno\n{{< /comment >}}\nThe {{< glossary_tooltip\ntext=\"kubelet\" term_id=\"k\" >}} runs {{jsxref(\"Array\")}}.\n{{SeeCompatTable}}\n\n## Set up {#set-up}\n\n{{% heading \"whatsnext\" %}}\n\n{{< note >}}\nSee {{< link text=\"Services\" url=\"/d\" >}}.\n{{< /note >}}\n"
    parsed = markup.parse_markdown(source, "f")
    assert parsed.title == "Probes"
    assert [(b.heading_path[-1:], b.text) for b in parsed.blocks] == [([], "The kubelet runs Array."), (["What's next"], "See Services.")]


def test_light_markup():
    rst = markup.parse_rst("SQLite\n======\n\nText::\n\n   literal\n\nPart\n----\n\n.. code-block:: sql\n\n   VACUUM;\n", "f")
    assert rst.title == "SQLite" and [(b.heading_path, b.text, b.kind) for b in rst.blocks] == [(["SQLite"], "Text:", "paragraph"), (["SQLite"], "literal", "code"), (["SQLite", "Part"], "VACUUM;", "code")]
    doc = markup.parse_asciidoc("= Git Manual\n\nIntro.\n\n== Commands\n\n[source,console]\n----\ngit status\n----\n", "f")
    assert doc.title == "Git Manual" and doc.blocks[-1] == (["Commands"], "git status", "code", {"language": "console"})
    man = markup.parse_man('.TH OPEN 2 "2026"\n.SH NAME\nopen \\- open a file\n.SH ERRORS\n.B EACCES\nPermission denied.\n', "f")
    assert man.title == "OPEN" and man.blocks[-1][:2] == (["ERRORS"], "EACCES Permission denied.")
    pod = markup.parse_pod("=head1 NAME\n\nopenssl-x - do B<it> I<C<now>>, E<lt>aE<gt> L<the page|page(1)>\n\n=head1 USE\n\n  run\n\n=cut\nno\n", "f")
    assert pod.title == "openssl-x" and pod.blocks[0].text == "openssl-x - do it now, <a> the page" and pod.blocks[1].kind == "code"
    text = markup.parse_text("one\n\ntwo\f\nthree\n", "f")
    assert [(b.text, b.attributes["page"]) for b in text.blocks] == [("one", "1"), ("two three", "2")]


def test_rfc():
    source = """Network Working Group                                     A. Author
Request for Comments: 9999                              Example Org
Obsoletes: 1234, 2345                                  January 2024
Category: Standards Track
ISSN: 2070-1721

                      A Small Protocol

Abstract

   This is the abstract.

Table of Contents

   1.  Introduction ................. 2

1.  Introduction

   Text of the introduction.

Author                   Informational                     [Page 1]

1.1.  Terms

   More.

Appendix A.  Notes

   Last.
"""
    parsed = markup.parse_rfc(source, "f")
    assert parsed.title == "A Small Protocol"
    paths = [b.heading_path for b in parsed.blocks]
    assert ["Abstract"] in paths and ["1. Introduction", "1.1. Terms"] in paths and ["Appendix A. Notes"] in paths
    assert not any("....." in b.text or "[Page" in b.text for b in parsed.blocks)
    assert markup.rfc_metadata(source) == {"rfc_number": "9999", "obsoletes": "1234,2345", "publication_status": "Standards Track", "issn": "2070-1721", "publication_date": "January 2024"}


def test_xml_formats():
    book = xml_docs.parse_docbook(
        "<refentry><refmeta><refentrytitle>tool</refentrytitle></refmeta><refnamediv><refname>tool</refname><refpurpose>does it</refpurpose></refnamediv>"
        "<refsect1 id='o'><title>Options</title><variablelist><varlistentry><term>-a</term><listitem><para>All &unknown; &amp; more.</para></listitem></varlistentry></variablelist>"
        "<programlisting>x\n y</programlisting><note><para>Care, see <citerefentry><refentrytitle>man</refentrytitle><manvolnum>1</manvolnum></citerefentry>.</para></note></refsect1></refentry>",
        "f",
    )
    assert [(b.heading_path, b.text, b.kind) for b in book.blocks] == [
        (["NAME"], "tool — does it", "paragraph"), (["Options", "-a"], "-a\nAll unknown & more.", "definition"), (["Options"], "x\n y", "code"), (["Options", "Note"], "Care, see man(1).", "paragraph")]
    web = xml_docs.parse_nginx_xml("<module name='Core'><section name='Directives'><directive name='listen'><syntax>port</syntax><default>80</default><context>server</context><para>Sets&nbsp;it, see <link id='x'/>.</para></directive></section></module>", "f")
    assert web.title == "Core" and [b.text for b in web.blocks] == ["listen port. Default: 80. Context: server", "Sets it, see x."]
    math = xml_docs.parse_cnxml("<document xmlns='c' xmlns:m='m'><title>Motion</title><content><section><title>Speed</title><para>v is <m:math><m:mfrac><m:mi>d</m:mi><m:mi>t</m:mi></m:mfrac></m:math>.</para></section></content></document>", "f")
    assert math.blocks == [(["Speed"], "v is (d)/(t) .", "paragraph", {})]
    assert xml_docs.collection_modules("<c><content><subcollection><title>U</title><module document='m1'/></subcollection><module document='m2'/></content></c>") == [(0, ["U"], "m1"), (1, [], "m2")]
    records = xml_docs.registry_records("<registry id='r'><title>Ports</title><record><value>22</value><name>ssh</name><xref type='rfc' data='rfc4251'/><xref type='rfc' data='rfc4251'/></record></registry>")
    assert xml_docs.render_record(records[0][2]) == "Value: 22\nName: ssh\nReferences: rfc4251"
    with pytest.raises(ValueError):
        xml_docs.parse_docbook("<a>", "f")


def test_go_and_wiki():
    source = """/* Package io reads.
 * And writes.
 */
package io

// Reader reads { and
// more.
type Reader interface {
\tRead() // }
}

var hidden = 1
const (
\tA = "}" // x
\tb = '{'
)
var Text = `func Fake() {`

func (r *File) Open(name string, f func(int) error) (n int, err error) {
\tfunc Inner() {}
}
func plain() {}
func Last[T any](x T)
"""
    go = files.parse("go/src/io/read.go", source)
    assert go.title == "package io — read"
    assert [(b.heading_path[1:], b.text, b.attributes.get("go_kind")) for b in go.blocks] == [
        ([], "Package io reads. And writes.", "package"),
        (["type Reader"], "Reader reads { and more.\n\ntype Reader interface {\n\tRead() // }\n}", "type"),
        (["Consts"], "const (\n\tA = \"}\" // x\n\tb = '{'\n)", "const"),
        (["var Text"], "var Text = `func Fake() {`", "var"),
        (["method (r *File) Open"], "func (r *File) Open(name string, f func(int) error) (n int, err error)", "method"),
        (["func Last"], "func Last[T any](x T)", "function"),
    ]
    text = "Lead '''bold''' [[link|label]]<ref>no</ref> {{box|{{x}}}}\n\n[[File:a.png|thumb|no]]\n== One ==\nBody [[plain]].\n=== Two ===\nInner.\n== Three ==\n\n"
    assert markup.wiki_sections(text) == [([], "Lead bold label"), (["One"], "Body plain."), (["One", "Two"], "Inner.")]


def test_choice_of_parser():
    assert files.parse("a/mod_proxy.html.en", "<title>m</title><p>x").format == "html"
    assert files.parse("podman.1.md.in", "% podman 1\n\ntext").format == "markdown"
    assert files.parse("rfc1.txt", "Request for Comments: 1\n\nTitle here\n").format == "rfc-text"
    assert files.parse("open.2", ".TH OPEN 2\n.SH NAME\nopen\n").format == "man"
    assert files.decode("é".encode("cp1252")) == "é" and files.decode("é".encode("utf-8-sig")) == "é"


def test_chunks():
    assert split_oversized("aaaa. bbbb cccc", 8) == ["aaaa.", "bbbb", "cccc"]
    assert split_oversized("x" * 25, 10) == ["x" * 10, "x" * 10, "x" * 5]
    blocks = [(["A"], "one", "p", {"id": "1"}), (["A"], "two", "code", {}), (["B"], "three", "p", {})]
    assert chunk_blocks(blocks, 100, 5) == [(["A"], "one\n\ntwo", {"id": "1", "block_kinds": "code,p"}), (["B"], "three", {"block_kinds": "p"})]
    assert [t for _, t, _ in chunk_blocks([(["A"], "x" * 60, "p", {}), (["A"], "y" * 50, "p", {}), (["A"], "z", "p", {})], 100, 20)] == ["x" * 60, "y" * 50 + "\n\nz"]
    assert chunk_section("a. b.\n\nshort", 100) == ["a. b.\n\nshort"]
    assert chunk_section("First one. Second one.", 12, 2) == ["First one.", "Second one."]


def test_markdown_links_and_addresses(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("[a](http://x.org/b) [c](d.md)", "HTTP://X.org/a/Index.html?q#f"), ("none", "mailto:x")], "t string, u string")
    got = df.select(files.markdown_links(F.col("t")).alias("l"), files.canonical_url(F.col("u")).alias("c"), files.within(F.lit("http://x.org/docs/a.png"), "http://x.org/docs").alias("w")).collect()
    assert got[0]["l"] == ["http://x.org/b", "d.md"] and got[0]["c"] == "http://x.org/a/" and got[1]["c"] is None and not got[0]["w"]
