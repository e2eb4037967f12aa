"""Hand-made pages without the generator's layouts: kept blocks begin with a plus sign, all others with a minus sign."""

P = "+A paragraph of the article, with some words in it and a mark or two."
Q = "+Another one follows here, which goes on for a while, as paragraphs of articles do."
LINKS = "<div><a href=a>-Home</a> <a href=b>-News</a> <a href=c>-Sport</a> <a href=d>-Weather</a></div>"
NAV = "<nav><ul><li><a href=a>-Home</a></li><li><a href=b>-About us</a></li><li><a href=c>-Contact</a></li></ul></nav>"
FOOT = "<footer><p>-&copy; 2024 Some Company. All rights reserved.</p></footer>"
PAGES = {
    "link paragraph in article": f"<body>{NAV}<article><h1>+Title of it</h1><p>{P}</p><p>+See <a href=x>the long report on the state of the rivers of the north</a>.</p><p>{Q}</p></article>{FOOT}</body>",
    "plain div between boxes": f"<body>{LINKS}<div><h1>+Title of it</h1><p>{P}</p><p>{Q}</p></div><div>-&copy; 2024 Some Company</div></body>",
    "link paragraph in plain div": f"<body>{LINKS}<div><h1>+Title of it</h1><p>{P}</p><p>+See <a href=x>the long report on the state of the rivers of the north</a>.</p></div><div>-&copy; 2024 Some Company</div></body>",
    "main after site header": f"<body><header><h1>-Site name</h1>{NAV}</header><main><h1>+Title of it</h1><p>+Short one.</p><p>{P}</p></main>{FOOT}</body>",
    "main with one short paragraph": f"<body><header><a href=/>-Site name</a></header><main><h1>+Title of it</h1><p>+Short one.</p></main>{FOOT}</body>",
    "section unnamed": f"<body>{NAV}<section><h2>+Title of it</h2><p>{P}</p><ul><li>+First point, briefly</li><li>+Second point</li></ul><p>{Q}</p></section><aside><h3>-Related</h3><a href=x>-Other story</a></aside>{FOOT}</body>",
    "nested divs": f"<body><div><div>{LINKS}<div><div><h1>+Title of it</h1><p>{P}</p><p>{Q}</p><p>+And a last one.</p></div></div><div>-&copy; Some Company, 2024. <a href=x>-Terms</a></div></div></div></body>",
    "blockquote and list": f"<body>{NAV}<article><h1>+Title of it</h1><p>{P}</p><blockquote><p>+Words of somebody, quoted here.</p></blockquote><ol><li>+One</li><li>+Two</li></ol><p>{Q}</p></article><div class='comments'><p>-Nice article, thanks a lot for it.</p></div>{FOOT}</body>",
    "advert inside": f"<body>{NAV}<article><h1>+Title of it</h1><p>{P}</p><div class='advert'>-Buy now, cheap watches</div><p>{Q}</p></article>{FOOT}</body>",
    "links within prose": f"<body>{NAV}<article><h1>+Title of it</h1><p>+The <a href=x>first</a> of the <a href=y>many small rivers</a> runs north, the <a href=z>second</a> runs south.</p><p>{P}</p></article>{FOOT}</body>",
    "table": f"<body>{NAV}<article><h1>+Title of it</h1><p>{P}</p><table><tr><td>+Rivers</td><td>+Twelve</td></tr><tr><td>+Lakes</td><td>+Three</td></tr></table></article>{FOOT}</body>",
    "notice first": f"<body><div class='cookie-banner'><p>-We use cookies, do you agree?</p><button>-Yes</button></div>{NAV}<div class='content'><h1>+Title of it</h1><p>{P}</p><p>+See also <a href=x>this page on the northern rivers and lakes</a>.</p></div><div class='sidebar'><h3>-More</h3><ul><li><a href=x>-A story</a></li></ul></div>{FOOT}</body>",
    "form after": f"<body>{NAV}<main><h1>+Title of it</h1><p>{P}</p><p>{Q}</p><form><label>-Your mail</label><input><button>-Subscribe</button></form></main>{FOOT}</body>",
    "plain paragraphs in body": f"<body>{LINKS}<h1>+Title of it</h1><p>{P}</p><p>{Q}</p><p>{P}</p><hr><div>-&copy; 2024 Some Company</div></body>",
    "long article in div": f"<body>{LINKS}<div><h1>+Title of it</h1>" + "".join(f"<p>{x}</p>" for x in (P, Q, P, Q, "+Short.", P)) + "<h2>+Part two</h2>" + f"<p>{Q}</p><p>+See <a href=x>what we wrote about the rivers of the north last year</a>.</p></div><div>-&copy; 2024 Some Company</div></body>",
}
